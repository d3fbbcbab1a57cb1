"""The online feature table: newest row per key, written by streams.

    batches/run=<query>/batch=<n>   newest rows of one micro-batch
    base-<id>/bucket=<b>            all earlier rows folded into one per key, by key bucket
    versions/v=<n>                  which base holds, and which batches it has folded in

A micro-batch adds only its own newest rows, in a folder named after the query and the
batch, so its cost does not grow with the table and a retried batch replaces itself. A
reader takes the last complete version: its base, and every batch that is not folded in.
`compact` writes a new base beside the old one, then the version that points to it; folders
that the version before last needed go then, so a stream and readers of the previous
version may run meanwhile. One compaction runs at a time; two would write one version
number, and the second is refused.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.errors import FeatureError
from ledgerlens.operators.store import latest_per_key, within_ttl
from ledgerlens.schema import ENTITY_KEY, EVENT_TIME, FEATURE_VIEW_SCHEMA, SOURCE_OFFSET, WRITTEN_AT
from ledgerlens.sources import folders

ONLINE_SCHEMA = T.StructType(
    [
        *FEATURE_VIEW_SCHEMA.fields,
        T.StructField(WRITTEN_AT, T.TimestampNTZType()),
        T.StructField(SOURCE_OFFSET, T.LongType()),
    ]
)
BUCKETS = 64
_BUCKET = "bucket"
_BASE_SCHEMA = T.StructType([*ONLINE_SCHEMA.fields, T.StructField(_BUCKET, T.IntegerType())])
_QUERY_ID = "sql.streaming.queryId"
_VERSION_SCHEMA = "kind string, path string"


def with_offset(rows: DataFrame, batch: int) -> DataFrame:
    """Adds the place of a row in its source where the source gives none: batch, then row."""
    if SOURCE_OFFSET in rows.columns:
        return rows
    return rows.withColumn(SOURCE_OFFSET, F.lit(batch).cast("long") * (1 << 45) + F.monotonically_increasing_id())


def stamped(rows: DataFrame, batch: int = 0) -> DataFrame:
    """Adds the write time and the offset; a stream's rows carry their own event time as
    write time, so that a replay writes the same table."""
    timed = rows if WRITTEN_AT in rows.columns else rows.withColumn(WRITTEN_AT, F.col(EVENT_TIME))
    return with_offset(timed, batch)


def write_batch(rows: DataFrame, path: str, run: str, batch: int) -> None:
    """Newest row per key of one batch; writing the same batch again replaces it."""
    newest = latest_per_key(stamped(rows, batch).select(*ONLINE_SCHEMA.names))
    newest.write.mode("overwrite").parquet(f"{path}/batches/run={run}/batch={batch}")


def run_of(spark: SparkSession) -> str:
    """The running stream's id, the same after a restart from its checkpoint."""
    return spark.sparkContext.getLocalProperty(_QUERY_ID) or "batch"


def upsert_into(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that upserts feature rows into the table at `path`."""

    def write(rows: DataFrame, batch: int) -> None:
        write_batch(rows, path, run_of(rows.sparkSession), batch)

    return write


# ---- versions


@dataclass(frozen=True)
class Version:
    number: int
    base: str | None
    folded: frozenset[str]
    last: dict[str, int] = field(default_factory=dict)  # highest folded batch of each run


def current_version(spark: SparkSession, path: str, back: int = 0) -> Version:
    """The last complete version, or the one `back` before it."""
    marks = folders.matches(spark, f"{path}/versions/v=*/_SUCCESS", 2)
    done = sorted(int(m.split("/")[0].removeprefix("v=")) for m in marks)
    if len(done) <= back:
        return Version(0, None, frozenset())
    number = done[-1 - back]
    rows = spark.read.schema(_VERSION_SCHEMA).json(f"{path}/versions/v={number}").collect()
    base = next((r.path for r in rows if r.kind == "base"), None)
    last = {k: int(n) for k, _, n in (r.path.rpartition("=") for r in rows if r.kind == "last")}
    return Version(number, base, frozenset(r.path for r in rows if r.kind == "folded"), last)


def _batches(spark: SparkSession, path: str) -> list[str]:
    """All complete batches, as run=<query>/batch=<n>; one listing."""
    marks = folders.matches(spark, f"{path}/batches/run=*/batch=*/_SUCCESS", 3)
    return [m.removesuffix("/_SUCCESS") for m in marks]


def _last_batches(batches: Iterable[str]) -> dict[str, int]:
    """The highest batch number of each run."""
    last: dict[str, int] = {}
    for b in batches:
        run, _, number = b.removeprefix("run=").rpartition("/batch=")
        last[run] = max(last.get(run, -1), int(number))
    return last


def next_batch(spark: SparkSession, path: str, run: str) -> int:
    """A batch number of a run that writes now and then; higher than any it had before,
    folded ones included, so that its rows are read and win ties. One writer per run."""
    known = _last_batches([*_batches(spark, path), *(f"run={k}/batch={n}" for k, n in current_version(spark, path).last.items())])
    return known.get(run, -1) + 1


# ---- reading


def _read(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    version = current_version(spark, path)
    fresh = [f"{path}/batches/{b}" for b in _batches(spark, path) if b not in version.folded]
    if version.base is None and not fresh:
        raise FeatureError(f"no online features at {path}")
    rows = spark.createDataFrame([], ONLINE_SCHEMA) if not fresh else spark.read.schema(ONLINE_SCHEMA).parquet(*fresh)
    if key is not None:
        rows = rows.where(F.col(ENTITY_KEY) == key)
    if version.base is not None:
        base = spark.read.schema(_BASE_SCHEMA).parquet(f"{path}/{version.base}")
        if key is not None:
            # A constant, so only one bucket's folder is listed and read.
            base = base.where((F.col(_BUCKET) == _bucket(F.lit(key))) & (F.col(ENTITY_KEY) == key))
        rows = rows.unionByName(base.drop(_BUCKET))
    return rows


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows that the current version holds, superseded ones included."""
    return _read(spark, path)


def read_online(spark: SparkSession, path: str, as_of: Column | None = None) -> DataFrame:
    """One row per key; with `as_of`, rows past their time to live are left out."""
    newest = latest_per_key(_read(spark, path))
    return newest if as_of is None else within_ttl(newest, as_of)


def read_key(spark: SparkSession, path: str, key: str, as_of: Column | None = None) -> DataFrame:
    """The row of one key: its bucket of the base, and a pushed filter on the fresh batches."""
    newest = latest_per_key(_read(spark, path, key))
    return newest if as_of is None else within_ttl(newest, as_of)


# ---- compaction


def compact(spark: SparkSession, path: str, as_of: Column | None = None) -> int:
    """Folds all complete batches into a new base; the number of the version made.

    With `as_of`, rows past their time to live are dropped for good.
    """
    before = current_version(spark, path)
    fresh = [b for b in _batches(spark, path) if b not in before.folded]
    rows = read_online(spark, path, as_of)
    base = f"base-{uuid.uuid4().hex}"
    by_bucket = rows.withColumn(_BUCKET, _bucket(F.col(ENTITY_KEY)))
    by_bucket.repartition(BUCKETS, _BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{base}")
    # Only of folders that are still there, so the list does not grow with the table's age.
    here = [b for b in _batches(spark, path) if b in before.folded or b in fresh]
    last = {k: max(n, before.last.get(k, -1)) for k, n in (before.last | _last_batches(here)).items()}
    names = [("base", base), *(("folded", b) for b in here)]
    names += [("last", f"{k}={n}") for k, n in last.items() if not _is_query(k)]
    number = before.number + 1
    # Fails if the version is there, so two compactions cannot both win.
    spark.createDataFrame(names, _VERSION_SCHEMA).coalesce(1).write.mode("error").json(f"{path}/versions/v={number}")
    _forget(spark, path, before)
    return number


def _forget(spark: SparkSession, path: str, previous: Version) -> None:
    """Deletes what neither the current nor the previous version reads."""
    current = current_version(spark, path)
    for folder in folders.names(spark, path):
        if folder.startswith("base-") and folder not in (current.base, previous.base):
            folders.delete(spark, f"{path}/{folder}")
    for batch in previous.folded:
        folders.delete(spark, f"{path}/batches/{batch}")


def _is_query(run: str) -> bool:
    """Streams count their batches themselves; their ids are not listed for ever."""
    return re.fullmatch("[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}", run) is not None
