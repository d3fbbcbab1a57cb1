import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import store
from ledgerlens.schema import ENTITY_KEY
from ledgerlens.streaming import state

@pytest.fixture
def topic(spark, tmp_path):
    """Writes rows as one more file of a stream, and gives the stream."""

    def make(*frames):
        folder = str(tmp_path / "topic")
        for frame in frames:
            frame.coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return make


def features(log, offset=0, hours=0):
    moved = log.withColumns({"source_offset": F.col("step").cast("long") + offset})
    view = store.build_offline(moved, ("source_offset",))
    return view.withColumn("event_timestamp", F.col("event_timestamp") + F.make_dt_interval(hours=F.lit(hours)))


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_state_equals_the_batch_form(spark, log, topic, tmp_path):
    first = features(log)
    again = features(log.where("step <= 20"), 1000).withColumn("dest_balance_error", F.lit(-1.5))
    older = features(log.where("step > 50"), 2000, hours=-5)
    stream = topic(first, again, older)
    state.keep_newest(stream, str(tmp_path / "c"))
    want = store.latest_per_key(first.unionByName(again).unionByName(older))
    got = state.read_newest(spark, str(tmp_path / "c"))
    assert got.count() == 60 and rows(got) == rows(want)
    assert got.where("dest_balance_error = -1.5").count() == 20


def test_restart_and_expiry(spark, log, topic, tmp_path):
    checkpoint, told = str(tmp_path / "c"), str(tmp_path / "changes")

    def changes(df, batch):
        df.write.mode("overwrite").parquet(f"{told}/batch={batch}")

    first, late = features(log), features(log.where("step = 60"), 100, hours=24 * 9)
    state.keep_newest(topic(first), checkpoint, days=10, changes=changes)
    assert state.read_newest(spark, checkpoint).count() == 60
    # One key moves on by nine days: the rest is ten days behind it, save what is not.
    stream = topic(late)
    state.keep_newest(stream, checkpoint, days=10, changes=changes)
    state.keep_newest(topic(late.limit(0)), checkpoint, days=10, changes=changes)
    kept = state.read_newest(spark, checkpoint)
    latest = late.agg(F.max("event_timestamp")).first()[0]
    want = store.within_ttl(store.latest_per_key(first.unionByName(late)), F.lit(latest), days=10)
    assert 0 < kept.count() < 60 and rows(kept) == rows(want)
    log_of_changes = spark.read.parquet(told)
    assert log_of_changes.where("live").count() == 61
    assert log_of_changes.where("NOT live").count() == 60 - kept.count()
    assert log_of_changes.where("NOT live").join(kept, ENTITY_KEY).isEmpty()


class Calls:
    """State, timers and handle of one key, which note every call."""

    def __init__(self):
        self.value, self.made = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.made.append("get")
        return self.value

    def update(self, value):
        self.made.append("update")
        self.value = value

    def registerTimer(self, moment):
        self.made.append("register")

    def deleteTimer(self, moment):
        self.made.append("delete")


def test_a_key_takes_plain_rows_and_few_calls():
    fields = [T.StructField("t", T.TimestampNTZType()), T.StructField("at", T.LongType()), T.StructField("x", T.DoubleType())]
    kept, calls = state._Newest(T.StructField("key", T.StringType()), fields), Calls()
    kept.init(calls)
    noon = datetime.datetime(2024, 1, 1, 12)

    def given(*rows):
        calls.made.clear()
        return list(kept.handleInputRows(("a",), iter([Row(x=x, at=at, t=t) for t, at, x in rows]), None))

    nan = float("nan")
    (out,) = given((noon, 1, None), (noon, 2, nan), (noon, 2, 5.0))  # NaN is greatest, as in Spark
    assert out.at == 2 and out.x != out.x and out.live and calls.made == ["get", "register", "update"]
    assert given((noon, 2, 7.0), (noon, 1, 8.0)) == [] and calls.made == ["get"]
    (out,) = given((noon, 3, None))  # the same time: the timer stays
    assert out.asDict() == {"key": "a", "t": noon, "at": 3, "x": None, "live": True} and calls.made == ["get", "update"]
    given((noon + datetime.timedelta(hours=1), 0, 1.0))
    assert calls.made == ["get", "delete", "register", "update"]


def odd_rows(spark):
    """Ties in time and offset that only values decide, nulls and NaN among them, and a hot key."""
    hour, nan = datetime.timedelta(hours=1), float("nan")
    noon = datetime.datetime(2024, 1, 1, 12)
    data = [
        ("a", noon, noon, 1, 2.0, "x"), ("a", noon, noon, 1, nan, "x"), ("a", noon, noon, 1, 9.0, "z"),
        ("b", noon, None, 1, None, "y"), ("b", noon, None, 1, None, None), ("b", noon, None, None, 5.0, "y"),
        ("c", noon, noon, 1, 1.0, "x"), ("c", noon + hour, None, 0, None, None), ("c", None, noon, 9, 9.0, "y"),
        (None, noon, noon, 1, 3.0, "x"), (None, noon, noon, 2, -0.0, "x"), ("d", noon, noon, 7, 1.0, "u"), ("d", noon, noon, 7, 1.0, "u"),
    ]
    data += [("hot", noon + (i % 7) * hour, noon, i, float(i), str(i)) for i in range(300)]
    fields = f"{ENTITY_KEY} string, event_timestamp timestamp_ntz, written_at timestamp, source_offset bigint, x double, s string"
    return spark.createDataFrame(data, fields)


@pytest.mark.parametrize("buckets", [state.BUCKETS, 2, 0])
def test_odd_rows_in_buckets_and_key_by_key(spark, topic, tmp_path, monkeypatch, buckets):
    monkeypatch.setattr(state, "CHUNK_ROWS", 50)
    given, checkpoint = odd_rows(spark), str(tmp_path / "c")
    if not buckets:  # a value per key knows no times with a zone
        given = given.withColumn("written_at", F.col("written_at").cast("timestamp_ntz"))
    later = given.where("x > 100").withColumn("x", F.col("x") + 0.5).withColumn("source_offset", F.col("source_offset") + 1000)
    told = []
    changes = lambda df, batch: told.extend(df.where("live").groupBy(ENTITY_KEY).count().collect())
    state.keep_newest(topic(given.where("x IS NULL OR x <= 1")), checkpoint, changes=changes, buckets=buckets)
    # A checkpoint goes on with the buckets that it began with.
    state.keep_newest(topic(given.where("NOT (x IS NULL OR x <= 1)"), later), checkpoint, changes=changes)
    want = store.latest_per_key(given.where("event_timestamp IS NOT NULL").unionByName(later))
    got = state.read_newest(spark, checkpoint)
    assert got.columns == [ENTITY_KEY, "event_timestamp", "written_at", "source_offset", "x", "s"]
    assert str(rows(got)) == str(rows(want)) and got.count() == 6  # NaN equals nothing
    assert max(r["count"] for r in told) == 1  # a key changes once a batch


def test_a_bucket_takes_few_calls():
    """Many keys with many rows: one read, one timer and one write of the state."""
    fields = [T.StructField("k", T.StringType()), T.StructField("t", T.TimestampNTZType()), T.StructField("at", T.LongType())]
    kept, calls = state._NewestOfBucket(fields), Calls()
    kept.init(calls)
    noon, hour = datetime.datetime(2024, 1, 1, 12), datetime.timedelta(hours=1)

    class Watermark:
        def getCurrentWatermarkInMs(self):
            return 0

    def given(*rows):
        calls.made.clear()
        batch = state.pa.RecordBatch.from_pylist([dict(zip(("k", "t", "at"), r)) for r in rows], kept.packed)
        out = list(kept.handleInputRows((3,), iter([Row(_packed=state._bytes(batch))]), Watermark()))
        return [r for o in out for r in state._batch(o[state.PACKED], kept.packed).to_pylist()]

    many = [(f"k{i % 500}", noon + (i // 500) * hour, i) for i in range(1500)]
    assert [r["at"] for r in given(*many)] == list(range(1000, 1500))
    assert calls.made == ["get", "register", "update"]
    assert given(*many[:700]) == [] and calls.made == ["get"]
    assert [r["at"] for r in given(("k7", noon + 2 * hour, 2000), ("k8", noon, 3000))] == [2000] and calls.made == ["get", "update"]
    assert len(given(("new", noon, 1))) == 1 and calls.made == ["get", "delete", "register", "update"]
