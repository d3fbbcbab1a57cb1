"""Newest row per key kept in the stream's own state, with a time to live.

The state store holds one row per key. A row is forgotten when an event is seen that is
more than its time to live later; the stream's watermark lags by that time, so what comes
later than that is dropped as expired already, and nothing else is. The rows can be read
from the checkpoint, as the batch form `latest_per_key` and `within_ttl` would give them.

A call from Python to the state takes about a millisecond, so keys are not kept one by one: a
hash deals them to `BUCKETS` buckets, and a bucket's rows are one value of the state, an Arrow
record batch. The rows of a micro-batch are shrunk to the newest per key and packed by bucket
before the shuffle, `CHUNK_ROWS` at a time, so Python moves whole batches and a hot key is small.
A batch reads and writes the buckets that it meets as a whole. Where small batches meet a large
state, `buckets=0` keeps a value per key, whose rows come one at a time as plain rows. A
checkpoint goes on with the buckets that it began with.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerlens.schema import ENTITY_KEY, EVENT_TIME, FEATURE_TTL_DAYS, SOURCE_OFFSET, WRITTEN_AT

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CLOCK, LIVE, NEWEST = "_clock", "live", "newest"
BUCKET, PACKED, OF = "_bucket", "_packed", "of_"
BUCKETS = 1 << 13
CHUNK_ROWS = 1 << 18
_EPOCH = datetime.datetime(1970, 1, 1)


def _rank(row: tuple) -> tuple:
    """Orders rows as Spark does: a null is smallest, NaN greatest."""
    return tuple((v is not None, v != v, v if v is not None and v == v else 0) for v in row)


class _Newest(StatefulProcessor):
    """Keeps a key's greatest row; columns are in the order in which they are compared."""

    def __init__(self, key: T.StructField, columns: Sequence[T.StructField]):
        self.key, self.columns = key.name, [f.name for f in columns]
        self.schema = T.StructType(list(columns))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.row = handle.getValueState(NEWEST, self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.row.get()
        old = None if held is None else tuple(held)
        best, rank = old, old and _rank(old)
        for row in rows:
            row = tuple(row[c] for c in self.columns)
            if rank is None or _rank(row) > rank:
                best, rank = row, _rank(row)
        if best is not old:
            if old is None or best[0] != old[0]:
                if old is not None:
                    self.handle.deleteTimer(_after(old[0]))
                self.handle.registerTimer(_after(best[0]))
            self.row.update(best)
            yield self._out(key, best, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        row = tuple(self.row.get())
        self.row.clear()
        yield self._out(key, row, False)

    def _out(self, key, row: tuple, live: bool) -> Row:
        return Row(**dict(zip((self.key, *self.columns, LIVE), (*key, *row, live))))

    def close(self) -> None:
        pass


def _after(moment: datetime.datetime) -> int:
    """The first millisecond after an event time: a row lives through its last moment."""
    return (moment.replace(tzinfo=None) - _EPOCH) // datetime.timedelta(milliseconds=1) + 1


# ---- many keys at once


def _plain(value):
    return tuple(map(_plain, value.values())) if isinstance(value, dict) else value


def newest_places(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Ascending places of the greatest row of each key; the first of equal ones.

    Column 0 is the key, the others are in the order in which they are compared. The leading
    whole numbers and times are compared as arrays, and only rows that tie on all of them one
    by one.
    """
    if rows.num_rows < 2:
        return np.arange(rows.num_rows)
    numbers = [_codes(rows.column(0))]
    for column in rows.columns[1:]:
        if not (pa.types.is_integer(column.type) or pa.types.is_timestamp(column.type)):
            break
        whole = column.cast(pa.int64(), safe=False)
        numbers += [np.asarray(whole.is_valid()), np.asarray(whole.fill_null(0))]
    order = np.lexsort(numbers[::-1])
    ends = np.flatnonzero(np.append(numbers[0][order[1:]] != numbers[0][order[:-1]], True))
    tied = np.append(False, np.all([x[order[1:]] == x[order[:-1]] for x in numbers], 0))  # to the row before
    best, compared = order[ends], rows.select(rows.schema.names[1:])
    for i in np.flatnonzero(tied[ends]):
        begin = ends[i]
        while tied[begin]:
            begin -= 1
        among = order[begin : ends[i] + 1]
        ranks = [_rank(tuple(map(_plain, r.values()))) for r in compared.take(pa.array(among)).to_pylist()]
        best[i] = among[ranks.index(max(ranks))]
    return np.sort(best)


def _codes(keys) -> np.ndarray:
    """A number per key; null is a key."""
    found = keys.dictionary_encode()
    found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
    return np.asarray(found.indices.fill_null(-1))


def _taken(rows: pa.Table, places: np.ndarray) -> pa.RecordBatch:
    return _whole(rows.take(pa.array(places)))


def _whole(rows: pa.Table) -> pa.RecordBatch:
    found = rows.combine_chunks().to_batches()
    return found[0] if found else pa.RecordBatch.from_pylist([], rows.schema)


def _bytes(rows: pa.RecordBatch) -> bytes:
    return rows.serialize().to_pybytes()


def _batch(packed: bytes, schema: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(packed), schema)


def _ends(rows: pa.RecordBatch) -> np.ndarray:
    """`_after` of the event times, which are column 1."""
    unit = {"s": 1000, "ms": 1, "us": -1000, "ns": -1_000_000}[rows.column(1).type.unit]
    moments = np.asarray(rows.column(1).cast(pa.int64()))
    return (moments * unit if unit > 0 else moments // -unit) + 1


def _packed(schema: pa.Schema):
    """Rows with their bucket, last, to one row per chunk and bucket: the newest of each key."""

    def chunk(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        rows = rows.take(pa.array(newest_places(rows.drop_columns(BUCKET))))
        bucket = np.asarray(rows.column(BUCKET))
        order = np.argsort(bucket, kind="stable")
        dealt, bucket = _whole(rows.drop_columns(BUCKET).take(pa.array(order)).cast(schema)), bucket[order]
        at = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        parts = [dealt.slice(a, b - a) for a, b in zip(at[:-1], at[1:])]
        newest = np.maximum.reduceat(np.asarray(dealt.column(1).cast(pa.timestamp("us")).cast(pa.int64())), at[:-1])
        clock = pa.array(newest).cast(pa.timestamp("us", "UTC"))
        return pa.record_batch([pa.array(bucket[at[:-1]]), clock, pa.array(map(_bytes, parts), pa.binary())], [BUCKET, CLOCK, PACKED])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
            if size >= CHUNK_ROWS:
                yield chunk(held)
                held, size = [], 0
        if size:
            yield chunk(held)

    return pack


def _unpacked(schema: pa.Schema, beside: Sequence[str] = ()):
    """Packed rows back to rows; columns `beside` are repeated."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, packed in enumerate(batch.column(PACKED)):
                rows = pa.Table.from_batches([_batch(packed.as_py(), schema)])
                for name in beside:
                    rows = rows.append_column(name, pa.repeat(batch.column(name)[i], rows.num_rows))
                yield from rows.to_batches()

    return unpack


class _NewestOfBucket(StatefulProcessor):
    """Keeps the greatest row of each key of a bucket, and when the first of them may expire.

    The first field of the state is never set: its name has the number of buckets and its type the
    columns that are packed, for those who read the state.
    """

    def __init__(self, fields: Sequence[T.StructField], buckets: int = BUCKETS):
        self.packed = to_arrow_schema(T.StructType(list(fields)))
        known = T.StructField(f"{OF}{buckets}", T.StructType(list(fields)))
        self.schema = T.StructType([known, T.StructField("due", T.LongType()), T.StructField(PACKED, T.BinaryType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getValueState(BUCKET, self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self.rows.get()
        old = [] if held is None else [_batch(held[2], self.packed)]
        new = pa.Table.from_batches([_batch(r[PACKED], self.packed) for r in rows])
        # Packed rows are as late as their newest: those that are expired already are left out here.
        here = np.flatnonzero(_ends(_whole(new)) >= timerValues.getCurrentWatermarkInMs())
        every = pa.concat_tables([pa.Table.from_batches(old, self.packed), new.take(pa.array(here))])
        best, known = newest_places(every), sum(b.num_rows for b in old)
        if best[-1:].size and best[-1] >= known:
            self._keep(_taken(every, best), None if held is None else held[1])
            yield self._out(key, _taken(every, best[best >= known]), True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = pa.Table.from_batches([_batch(self.rows.get()[2], self.packed)])
        ends = _ends(_whole(rows))
        gone = (ends < timerValues.getCurrentWatermarkInMs()) | (ends <= expiredTimerInfo.getExpiryTimeInMs())
        if gone.all():
            self.rows.clear()
        else:
            self._keep(_taken(rows, np.flatnonzero(~gone)), None)
        if gone.any():
            yield self._out(key, _taken(rows, np.flatnonzero(gone)), False)

    def _keep(self, rows: pa.RecordBatch, due: int | None) -> None:
        """One timer a bucket; one that is early finds nothing to drop and is set anew."""
        first = int(_ends(rows).min())
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(first)
            due = first
        self.rows.update((None, due, _bytes(rows)))

    def _out(self, key, rows: pa.RecordBatch, live: bool) -> Row:
        return Row(**{BUCKET: key[0], LIVE: live, PACKED: _bytes(rows)})

    def close(self) -> None:
        pass


# ---- streams


def newest_rows(rows: DataFrame, days: int = FEATURE_TTL_DAYS, key: str = ENTITY_KEY, buckets: int = BUCKETS) -> DataFrame:
    """A stream of changes: the new newest row of a key (`live`), or the one that expired.

    Rows without an event time cannot be ordered in time and are left out. Needs the
    RocksDB state store (`keep_newest` sets it). `buckets`: see the module.
    """
    clocks = [c for c in (EVENT_TIME, WRITTEN_AT, SOURCE_OFFSET) if c in rows.columns]
    others = [c for c in rows.columns if c != key and c not in clocks]
    columns = [rows.schema[c] for c in (*clocks, *others)]
    timed = rows.where(F.col(EVENT_TIME).isNotNull())
    made = T.StructType([rows.schema[key], *columns, T.StructField(LIVE, T.BooleanType())])
    late = f"{days} days"
    if not buckets:
        keyed = timed.withColumn(CLOCK, F.col(EVENT_TIME).cast("timestamp")).withWatermark(CLOCK, late).groupBy(key)
        return keyed.transformWithState(_Newest(rows.schema[key], columns), made, "Update", "EventTime")
    fields = [rows.schema[key], *columns]
    schema = to_arrow_schema(T.StructType(fields))
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)
    dealt = timed.select(key, *[f.name for f in columns], bucket)
    packed = dealt.mapInArrow(_packed(schema), f"{BUCKET} int, {CLOCK} timestamp, {PACKED} binary").withWatermark(CLOCK, late)
    changes = packed.groupBy(BUCKET).transformWithState(
        _NewestOfBucket(fields, buckets), f"{BUCKET} int, {LIVE} boolean, {PACKED} binary", "Update", "EventTime"
    )
    return changes.mapInArrow(_unpacked(schema, [LIVE]), made)


def keep_newest(
    rows: DataFrame,
    checkpoint: str,
    days: int = FEATURE_TTL_DAYS,
    changes: Callable[[DataFrame, int], None] = lambda changed, batch: changed.write.format("noop").mode("append").save(),
    buckets: int = BUCKETS,
) -> None:
    """Runs over all that is available now; a later call with the checkpoint goes on."""
    spark = rows.sparkSession
    _, begun = _state(spark, checkpoint)
    buckets = buckets if begun is None else begun
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        query = (
            newest_rows(rows, days, buckets=buckets)
            .writeStream.option("checkpointLocation", checkpoint)
            .outputMode("update")
            .foreachBatch(changes)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _state(spark: SparkSession, checkpoint: str) -> tuple[DataFrame | None, int | None]:
    """The state and its number of buckets (0: a value per key); nothing where no stream began."""
    for name in (BUCKET, NEWEST):
        try:
            state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()
        except PySparkException:
            continue
        return state, int(state.schema["value"].dataType[0].name.removeprefix(OF)) if name == BUCKET else 0
    return None, None


def read_newest(spark: SparkSession, checkpoint: str, key: str = ENTITY_KEY) -> DataFrame:
    """The rows that the state holds after the last batch of the stream."""
    state, buckets = _state(spark, checkpoint)
    if state is None:
        raise FileNotFoundError(f"no stream has kept rows in {checkpoint}")
    if not buckets:
        return state.select(F.col(f"key.{key}").alias(key), "value.*")
    fields = state.schema["value"].dataType[0].dataType
    return state.select(f"value.{PACKED}").mapInArrow(_unpacked(to_arrow_schema(fields)), fields)
