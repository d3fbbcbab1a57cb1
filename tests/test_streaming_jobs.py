import json

import pytest
from pyspark.sql import functions as F

from helpers import SMALL
from ledgerlens.errors import DriftError, FeatureError, PredictionLogError, QualityError, SplitError
from ledgerlens.functions import wire
from ledgerlens.operators import drift, models, split, store
from ledgerlens.plans import jobs
from ledgerlens.schema import ENTITY_KEY, FEATURE_NAMES
from ledgerlens.sources import events, folders, tables
from ledgerlens.streaming import jobs as stream_jobs
from ledgerlens.streaming import online, source


@pytest.fixture
def topic(tmp_path, log):
    """A folder of message files: sixty good messages and five bad ones."""
    folder = tmp_path / "topic"
    folder.mkdir()
    good = [r.value for r in log.select(wire.wire_json().alias("value")).collect()]
    overflow = json.dumps({**json.loads(good[0]), "amount": "1e999"})
    bad = ["not json", "[1]", '{"step": 1}', json.dumps({**json.loads(good[0]), "type": "X"}), overflow]
    for i, lines in enumerate((good[:30] + bad[:2], good[30:] + bad[2:])):
        (folder / f"{i}.txt").write_text("\n".join(lines) + "\n")
    return str(folder)


def run(stream, tmp_path, name="out"):
    path = str(tmp_path / name)
    stream_jobs.run_bounded(stream, path, str(tmp_path / f"{name}-checkpoint"))
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def test_stream_equals_batch_bit_for_bit(spark, topic, log, tmp_path):
    streamed = run(stream_jobs.feature_rows(source.text_messages(spark, topic)), tmp_path)
    batch = store.build_offline(log)
    assert store.parity(streamed, batch).isEmpty()
    assert streamed.count() == 60


def test_status_keeps_going_and_tells_why(spark, topic, tmp_path):
    status = run(stream_jobs.status_rows(source.text_messages(spark, topic)), tmp_path)
    counts = {(r.status, r.kind, r.reason): r["count"] for r in status.groupBy("status", "kind", "reason").count().collect()}
    assert counts == {
        ("OK", None, None): 60,
        ("SKIPPED", "invalid", "not_an_object"): 2,
        ("SKIPPED", "invalid", "missing:type"): 1,
        ("SKIPPED", "invalid", "invalid:type"): 1,
        ("SKIPPED", "processing", "processing:amount"): 1,
    }
    assert status.where("status = 'OK' AND transaction_id IS NULL").isEmpty()


def test_first_valid_messages(spark, topic):
    rows = spark.read.text(topic).withColumn("offset", F.monotonically_increasing_id())
    assert stream_jobs.first_valid(rows, 10, ("offset",)).count() == 10
    assert stream_jobs.first_valid(rows, 1000, ("offset",)).count() == 61


def upsert(spark, topic, path, checkpoint):
    rows = stream_jobs.feature_rows(source.text_messages(spark, topic, files_per_batch=1))
    stream_jobs.run_batches(rows, online.upsert_into(path), checkpoint)


def test_upsert_restart_and_replay(spark, topic, log, tmp_path):
    path = str(tmp_path / "online")
    upsert(spark, topic, path, str(tmp_path / "c1"))
    first = online.read_online(spark, path).collect()
    assert len(first) == 60
    upsert(spark, topic, path, str(tmp_path / "c1"))  # nothing new
    assert online.read_rows(spark, path).count() == 60
    upsert(spark, topic, path, str(tmp_path / "c2"))  # all again
    assert online.read_rows(spark, path).count() == 120
    assert sorted(online.read_online(spark, path).collect()) == sorted(first)
    key = first[0].transaction_id
    reader = online.read_online(spark, path)  # of the version before
    assert online.compact(spark, path) == 1
    assert sorted(reader.collect()) == sorted(first)
    assert online.read_rows(spark, path).count() == 60
    one = online.read_key(spark, path, key)
    assert one.collect() == [first[0]] and online.read_key(spark, path, "nobody").isEmpty()
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(online.read_online(spark, path).collect()) == sorted(first)
    assert store.parity_counts(online.read_online(spark, path), store.build_offline(log)).first() == (60, 0, 0)


def test_compaction_beside_a_stream(spark, log, tmp_path):
    """Batches that arrive after a version was taken are read with it and folded later."""
    path = str(tmp_path / "online")
    view = store.build_offline(log)
    online.write_batch(view.where("hour_of_day < 12"), path, "a", 0)
    online.compact(spark, path)
    reader = online.read_online(spark, path)
    online.write_batch(view.where("hour_of_day >= 12"), path, "a", 1)
    assert online.read_online(spark, path).count() == 60
    online.compact(spark, path)
    assert reader.count() == 35  # steps 1 to 11, 24 to 35 and 48 to 59
    as_of = F.to_timestamp_ntz(F.lit("2024-01-02 06:00:00")) + F.expr("INTERVAL 3650 DAYS")
    assert online.compact(spark, path, as_of) == 3
    assert online.read_rows(spark, path).count() == 31
    current = online.current_version(spark, path)
    assert len([f for f in folders.names(spark, path) if f.startswith("base-")]) == 2 and current.number == 3


def test_the_last_message_of_a_key_wins(spark, log, tmp_path):
    path = str(tmp_path / "online")
    first = log.where("step = 1").withColumn("source_offset", F.lit(7).cast("long"))
    later = first.withColumns({"newbalanceDest": F.col("newbalanceDest") + 90, "source_offset": F.lit(9).cast("long")})
    for batch, rows in enumerate((later, first)):  # the late one is written first
        online.write_batch(store.build_offline(rows, ("source_offset",)), path, "a", batch)
    assert online.read_online(spark, path).first().dest_balance_error == -90.0
    both = store.build_offline(first.unionByName(later), ("source_offset",))
    assert store.latest_per_key(both).first().dest_balance_error == -90.0


def test_worker_writes_features_and_status_in_one_pass(spark, topic, tmp_path):
    online_path, status_path = str(tmp_path / "online"), str(tmp_path / "status")
    for checkpoint in ("c1", "c1", "c2"):  # a restart finds nothing new; a replay writes all again
        stream = source.text_messages(spark, topic, files_per_batch=1)
        stream_jobs.run_batches(stream, stream_jobs.worker(online_path, status_path), str(tmp_path / checkpoint))
    assert online.read_online(spark, online_path).count() == 60
    counts = {(r.status, r.kind): r["count"] for r in stream_jobs.read_status(spark, status_path).groupBy("status", "kind").count().collect()}
    assert counts == {("OK", None): 120, ("SKIPPED", "invalid"): 8, ("SKIPPED", "processing"): 2}


def test_newest_row_wins(spark, log, tmp_path):
    path = str(tmp_path / "online")
    view = store.build_offline(log.where("step = 1"))
    later = view.withColumns({"event_timestamp": F.col("event_timestamp") + F.expr("INTERVAL 1 HOUR"), "hour_of_day": F.lit(9).cast("long")})
    online.write_batch(later, path, "a", 0)
    online.write_batch(view, path, "a", 1)
    assert online.read_online(spark, path).first().hour_of_day == 9
    online.write_batch(view, path, "a", 0)  # the same batch again replaces itself
    assert online.read_online(spark, path).first().hour_of_day == 1


def test_write_time_breaks_equal_event_times(spark, log, tmp_path):
    path = str(tmp_path / "online")
    view = store.build_offline(log.where("step = 1"))
    for batch, (hour, value) in enumerate([("2024-02-01 02:00:00", 5), ("2024-02-01 01:00:00", 3)]):
        stamped = view.withColumns({"hour_of_day": F.lit(value).cast("long"), "written_at": F.to_timestamp_ntz(F.lit(hour))})
        online.write_batch(stamped, path, "a", batch)
    assert online.read_online(spark, path).first().hour_of_day == 5


def test_hot_key_collapses_to_one_row(spark, log):
    many = store.build_offline(log.where("step <= 2")).crossJoin(spark.range(20000)).drop("id")
    assert store.latest_per_key(many).count() == 2


def test_a_materialization_after_a_compaction_is_served(spark, csv, dict_rows, tmp_path):
    paths = [str(tmp_path / n) for n in ("offline", "online")]
    jobs.materialize(spark, csv(dict_rows[:20], name="a.csv"), *paths)
    online.compact(spark, paths[1])
    jobs.materialize(spark, csv(dict_rows[20:45], name="b.csv"), *paths)
    assert online.read_online(spark, paths[1]).count() == 45
    online.compact(spark, paths[1])
    online.compact(spark, paths[1])  # drops the folders of both
    changed = store.build_offline(log_of(spark, dict_rows[:1])).withColumn("hour_of_day", F.lit(7).cast("long"))
    online.write_batch(changed, paths[1], jobs.MATERIALIZED, online.next_batch(spark, paths[1], jobs.MATERIALIZED))
    assert online.next_batch(spark, paths[1], jobs.MATERIALIZED) == 3
    assert online.read_online(spark, paths[1]).where("hour_of_day = 7").count() == 3  # steps 7 and 31, and the changed one
    assert online.read_online(spark, paths[1]).count() == 45


def log_of(spark, rows):
    from ledgerlens.schema import TRANSACTION_SCHEMA

    return spark.createDataFrame([tuple(r[n] for n in TRANSACTION_SCHEMA.names) for r in rows], TRANSACTION_SCHEMA)


def test_time_to_live(spark, log, tmp_path):
    path = str(tmp_path / "online")
    online.write_batch(store.build_offline(log), path, "a", 0)
    as_of = F.to_timestamp_ntz(F.lit("2024-01-02 06:00:00")) + F.expr("INTERVAL 3650 DAYS")
    assert online.read_online(spark, path, as_of).count() == 31
    with pytest.raises(FeatureError):
        online.read_online(spark, str(tmp_path / "absent"))


def test_live_windows_equal_batch_up_to_the_watermark(spark, tmp_path):
    live = events.outcome_log(
        source.event_transactions(spark, SMALL), events.stored_features(events.transactions(spark, SMALL))
    )
    got = run(stream_jobs.live_windows(live, "1 hour"), tmp_path)
    assert got.count() > 0
    assert got.groupBy("window_start").count().where("count > 1").isEmpty()


def test_late_rows_do_not_reopen_a_window(spark, tmp_path):
    folder = tmp_path / "in"
    schema = "logged_at timestamp, outcome string"
    for i, times in enumerate((["2024-01-01 00:00:10"], ["2024-01-01 02:00:00"], ["2024-01-01 00:00:20", "2024-01-01 03:00:00"])):
        rows = spark.createDataFrame([(t, "success") for t in times], "t string, outcome string")
        typed = rows.select(F.col("t").cast("timestamp").alias("logged_at"), "outcome")
        typed.coalesce(1).write.parquet(str(folder / str(i)))
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
        out = run(stream_jobs.live_windows(stream, "10 minutes"), tmp_path)
    early = out.where("window_start < TIMESTAMP '2024-01-01 01:00:00'").collect()
    assert [r.requests_per_second for r in early] == [pytest.approx(1 / 60)]


# ---- feature table jobs


def test_materialize_window_and_latest(log):
    window = store.materialize_window(log)
    assert [str(v) for v in window.first()] == ["2024-01-01 00:00:00", "2024-01-03 13:00:00"]
    view = store.build_offline(log)
    assert store.materialize(view, window).count() == 60
    early = store.materialize_window(log.where("step <= 10"))
    assert store.materialize(view, early).count() == 10


def test_parity_finds_both_sides(log):
    a, b = store.build_offline(log.where("step <= 50")), store.build_offline(log.where("step > 10"))
    assert store.parity_counts(a, b).first() == (40, 10, 10)
    assert {r.side: r["count"] for r in store.parity(a, b).groupBy("side").count().collect()} == {"left": 10, "right": 10}


# ---- chains


def test_preprocess_and_daily(spark, csv, dict_rows, tmp_path):
    path = csv(dict_rows)
    table = jobs.daily(spark, path, *(str(tmp_path / n) for n in ("splits", "offline", "online")), rows=20)
    assert table.count() == 20
    written = tables.read_splits(spark, str(tmp_path / "splits"))
    assert {r.split: r.rows for r in split.summary(written).collect()} == {"train": 42, "validation": 9, "test": 9}
    assert set(FEATURE_NAMES) < set(written.columns) and ENTITY_KEY not in written.columns


def test_a_refused_split_leaves_the_old_table(spark, csv, dict_rows, tmp_path):
    out = str(tmp_path / "splits")
    jobs.preprocess(spark, csv(dict_rows), out)
    for r in dict_rows:
        r["isFraud"] = int(r["step"] == 4)
    with pytest.raises(SplitError):
        jobs.preprocess(spark, csv(dict_rows, name="bad.csv"), out)
    assert tables.read_splits(spark, out).where("isFraud = 1").count() == 15


def test_preprocess_refuses_a_log_without_positives(spark, csv, dict_rows, tmp_path):
    for r in dict_rows:
        r["isFraud"] = 0
    with pytest.raises(QualityError):
        jobs.preprocess(spark, csv(dict_rows), str(tmp_path / "splits"))


def test_weekly(spark, csv, dict_rows, tmp_path):
    got = jobs.weekly(spark, csv(dict_rows), str(tmp_path / "s"), str(tmp_path / "m"), models.MODEL_SPECS[:1])
    row = got.first()
    assert row.true_positives + row.false_negatives + row.true_negatives + row.false_positives == 9


def test_monthly(spark, csv, dict_rows, log, tmp_path):
    path, profile = str(tmp_path / "log"), str(tmp_path / "profile")
    with pytest.raises(PredictionLogError):
        jobs.monthly(spark, path, profile, drift.DISTANCES)
    served = log.withColumns(
        {
            "amount": F.col("amount") * 5,
            "prediction": F.lit(0),
            "fraud_probability": F.lit(0.1),
            "model_version": F.lit("1"),
        }
    )
    tables.append_log(served, path)
    with pytest.raises(DriftError, match="profile"):
        jobs.monthly(spark, path, profile, drift.DISTANCES)
    jobs.profile_reference(spark, csv(dict_rows), profile)
    (tmp_path / "log.csv").unlink()  # no training row is read again
    got = jobs.monthly(spark, path, profile, drift.DISTANCES).first()
    assert (got.drifted_columns, got.total_columns) == (1, 4)


def test_sample_keeps_all_positives(log):
    picked = jobs.sample(log, "nameOrig", 20)
    assert picked.count() == 35
    assert picked.where("isFraud = 1").count() == 15
    assert jobs.sample(log, "nameOrig").count() == 60
