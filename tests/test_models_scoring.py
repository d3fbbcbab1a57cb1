import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.errors import FeatureError, ModelError, PredictionLogError
from ledgerlens.operators import metrics, models, scoring, store
from ledgerlens.plans import jobs
from ledgerlens.schema import FEATURE_NAMES, LABEL, MODEL_INPUTS
from ledgerlens.sources import batch_log, folders, tables
from ledgerlens.streaming import jobs as stream_jobs

QUICK = models.MODEL_SPECS[:2]


@pytest.fixture(scope="module")
def data(log):
    return jobs.processed(log).cache()


def test_spec_names_and_settings(spark):
    counts = models.ClassCounts(90, 10)
    forest = models.MODEL_SPECS[1].build(MODEL_INPUTS, counts).getStages()[-1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getSubsamplingRate()) == (100, 14, 0.3)
    level = models.MODEL_SPECS[2].build(MODEL_INPUTS, counts).getStages()[-1]
    assert (level.getMaxIter(), level.getMaxDepth(), level.getStepSize()) == (200, 6, 0.1)
    line = models.MODEL_SPECS[0].build(MODEL_INPUTS, counts).getStages()[-1]
    assert (line.getMaxIter(), line.getRegParam()) == (200, 0.01)


def test_weights(log):
    assert models.class_counts(log).first() == (45, 15, 3.0)
    got = {r.isFraud: r.weight for r in models.balanced_weights(log).collect()}
    assert got == {1: 2.0, 0: 60 / 90}
    assert models.class_counts(log.where("isFraud = 0")).first().positive_weight == 1.0
    both = models.weighted(log, models.MODEL_SPECS[0], models.ClassCounts(45, 15))
    assert both.agg(F.sum("_weight")).first()[0] == pytest.approx(60.0)
    one_sided = models.weighted(log, models.MODEL_SPECS[2], models.ClassCounts(45, 15))
    assert {r[0] for r in one_sided.select("_weight").distinct().collect()} == {1.0, 3.0}


def test_standardize_uses_the_fitted_rows_only(log):
    fitted_on = log.where("step <= 42")
    got = models.standardize(log, fitted_on, ["amount", "oldbalanceOrg"])
    on_train = got.where("step <= 42").agg(F.avg("amount"), F.stddev_pop("amount")).first()
    assert on_train[0] == pytest.approx(0.0, abs=1e-12) and on_train[1] == pytest.approx(1.0)
    assert got.agg(F.max("amount")).first()[0] > 1.7
    assert got.agg(F.max(F.abs("oldbalanceOrg"))).first()[0] == 0.0


def test_assemble_needs_the_label(data):
    first = models.assemble(data).orderBy("step").first()
    assert first.features.size == len(MODEL_INPUTS) and first.features[0] == 1.0
    with pytest.raises(ModelError, match="isFraud"):
        models.assemble(data.drop(LABEL))
    assert models.feature_order(data.columns) == MODEL_INPUTS


def test_train_register_evaluate(spark, data, tmp_path):
    folder = str(tmp_path / "models")
    assert jobs.train(spark, data, folder, specs=QUICK) == "1"
    assert jobs.train(spark, data, folder, specs=QUICK[:1]) == "2"

    saved = spark.read.parquet(f"{folder}/runs")
    assert saved.count() == 6
    for r in saved.collect():
        assert 0.0 <= r.average_precision <= 1.0
        assert r.feature_version == "d6bdfb2a6697"
    best = metrics.best_run(saved).first()
    assert best.average_precision == saved.where("split = 'validation'").agg(F.max("average_precision")).first()[0]

    version, run_id = jobs.models.versions.resolve(models.read_versions(spark, folder), jobs.MODEL_NAME)
    assert version == "2"
    assert models.load_feature_names(spark, folder, run_id) == MODEL_INPUTS
    again = models.evaluate_version(spark, data, folder, jobs.MODEL_NAME).first()
    stored = saved.where((F.col("run_id") == run_id) & (F.col("split") == "test")).first()
    assert (again.average_precision, again.true_positives) == (stored.average_precision, stored.true_positives)
    with pytest.raises(ModelError, match="not recorded"):
        models.load_feature_names(spark, folder, "nobody")
    with pytest.raises(ModelError, match="registered"):
        models.evaluate_version(spark, data, folder, "another")


def test_boosted_specs_fit(data):
    train = data.where("split = 'train'")
    for spec in models.MODEL_SPECS[2:]:
        small = models.ModelSpec(spec.name, lambda order, c, s=spec: _short(s.build(order, c)), spec.balanced)
        scored = models.score(train, models.fit(train, small))
        assert scored.count() == 42
        assert scored.where("fraud_probability < 0 OR fraud_probability > 1").isEmpty()


def _short(pipeline):
    pipeline.getStages()[-1].setMaxIter(3)
    return pipeline


@pytest.fixture(scope="module")
def model(data):
    return models.fit(data.where("split = 'train'"), models.MODEL_SPECS[0])


def test_train_rows_are_dealt_in_bounded_parts(data, monkeypatch):
    train = data.where("split = 'train'").coalesce(1)
    counts = models.count_classes(train)
    assert models.dealt(train, counts).rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "ROWS_A_TASK", 4)
    parts = models.dealt(train, counts)
    sizes = parts.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert max(sizes) <= 8 and sum(sizes) == counts.rows
    assert sorted(map(str, parts.collect())) == sorted(map(str, train.collect()))


def test_scores_keep_row_columns(data, model):
    scored = models.score(data, model, "4")
    assert scored.columns == [*data.columns, "prediction", "fraud_probability", "model_version"]
    assert dict(scored.dtypes)["prediction"] == "bigint"


# ---- requests


def test_served_requests_equal_direct_scores(log, data, model):
    stored = store.build_offline(log)
    served = scoring.score_requests(log.drop(LABEL), stored, model, "7")
    direct = models.score(data, model).select("step", F.col("fraud_probability").alias("want"))
    joined = served.join(direct, "step").collect()
    assert len(joined) == 60
    assert all(r.fraud_probability == r.want and r.model_version == "7" for r in joined)


def test_outcomes(log, row):
    stored = store.build_offline(log.where("step <= 40"))
    blank = store.build_offline(log.where("step = 41")).withColumns({n: F.lit(None).cast("double") for n in FEATURE_NAMES})
    requests = log.drop(LABEL).unionByName(row(amount=-1.0).drop(LABEL))
    found = scoring.outcomes(requests, stored.unionByName(blank))
    counts = {(r.outcome, r.reason): r["count"] for r in found.groupBy("outcome", "reason").count().collect()}
    assert counts == {
        ("success", None): 40,
        ("features_unavailable", None): 20,
        ("malformed", "negative:amount"): 1,
    }
    waiting = scoring.outcomes(requests, stored, ready=F.col("step") > 10)
    assert waiting.where("outcome = 'not_ready'").count() == 11  # step 1 comes twice
    assert waiting.where("outcome = 'malformed'").isEmpty()
    assert scoring.missing_features(log, stored.unionByName(blank)).count() == 20


def test_hot_keys_are_answered_like_the_rest(spark, log):
    """Half of the requests share one stored key, a quarter one that is not stored."""
    many = log.unionByName(log.where("step = 3").crossJoin(spark.range(4000)).drop("id"))
    many = many.unionByName(log.where("step = 50").crossJoin(spark.range(2000)).drop("id"))
    stored = store.build_offline(log.where("step <= 40"))
    found = scoring.lookup(many, stored)
    assert found.count() == 6060
    assert found.where("hour_of_day IS NOT NULL").count() == 4040
    assert found.where("hour_of_day <> pmod(step, 24)").isEmpty()
    missing = scoring.missing_features(many, stored)
    assert missing.count() == 2020
    assert sorted(r.step for r in missing.select("step").distinct().collect()) == list(range(41, 61))


def test_hot_keys_are_split_whatever_their_number(spark, log):
    """One key with half of the requests: no task reads near that many, in two scans."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 200))
        requests = spark.range(40_000, numPartitions=8).select(F.col("id").alias("event_id"), key.alias("transaction_id"))
        stored = store.build_offline(log.where("step = 1")).withColumn("transaction_id", F.lit("hot"))
        found = scoring.lookup(requests, stored).withColumn("task", F.spark_partition_id())
        sizes = [r["count"] for r in found.groupBy("task").count().collect()]
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 40_000 and max(sizes) <= 8_000
    assert plan.count("Exchange hashpartitioning") <= 4


def test_stream_lookup_equals_the_batch(spark, log, tmp_path):
    folder = str(tmp_path / "in")
    log.unionByName(log.where("step = 3").crossJoin(spark.range(50)).drop("id")).write.parquet(folder)
    stored = store.build_offline(log.where("step <= 40"))
    stream = scoring.lookup(spark.readStream.schema(log.schema).parquet(folder), stored)
    stream_jobs.run_bounded(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    batch = scoring.lookup(spark.read.schema(log.schema).parquet(folder), stored)
    assert got.count() == 110 and got.exceptAll(batch.select(*got.columns)).isEmpty()


def test_result_row(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.12345678, 3.14159), (0, 1, 0.5, 1.0), (1, None, None, None)],
        "truth long, prediction long, fraud_probability double, latency_ms double",
    )
    got = [tuple(r)[2:] for r in scoring.result_row(df).collect()]
    assert got == [(0.123457, 3.14, True), (0.5, 1.0, False), (None, None, None)]


# ---- prediction log


def test_log_round_trip(spark, log, data, model, tmp_path):
    path = str(tmp_path / "log")
    served = scoring.score_requests(log, store.build_offline(log), model, "2")
    assert tables.append_log(served, path) and tables.append_log(served, path)
    back = tables.read_prediction_log(spark, path)
    assert back.count() == 120
    one = back.where("step = 1").first()
    assert (one.amount, one.type, one.model_version) == (100.0, "PAYMENT", "2")
    assert one.logged_at.endswith("+00:00") and "T" in one.logged_at


def test_log_skips_blank_lines_and_refuses_nothing(spark, tmp_path):
    path = tmp_path / "log.jsonl"
    path.write_text("\n" + json.dumps({"step": 1, "prediction": 0}) + "\n   \n\n")
    assert [r.step for r in tables.read_prediction_log(spark, str(path)).collect()] == [1]
    path.write_text("half a li\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        tables.read_prediction_log(spark, str(path)).collect()
    path.write_text("\n\n")
    with pytest.raises(PredictionLogError, match="empty"):
        tables.read_prediction_log(spark, str(path))
    with pytest.raises(PredictionLogError, match="nothing"):
        tables.read_prediction_log(spark, str(tmp_path / "absent"))


def test_a_log_that_cannot_be_written_does_not_fail_scoring(log, model, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("in the way")
    served = scoring.score_requests(log, store.build_offline(log), model, "1")
    assert tables.append_log(served, f"{blocked}/log") is False
    with pytest.raises(Exception, match="prediction"):  # a fault in the program is not swallowed
        tables.append_log(served.drop("prediction"), str(tmp_path / "log"))
    broken = served.withColumn("amount", F.raise_error(F.lit("no amount")).cast("double"))
    with pytest.raises(Exception, match="no amount"):
        tables.append_log(broken, str(tmp_path / "log"))


def test_score_stream_logs_every_batch(spark, log, data, model, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "log")
    log.repartition(3).write.parquet(folder)
    requests = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    stored = store.build_offline(log.where("step <= 40"))
    jobs.score_stream(requests, stored, model, "3", path, str(tmp_path / "checkpoint"))
    assert tables.read_prediction_log(spark, path).count() == 40


def test_a_batch_is_logged_once(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(i,) for i in range(10)], "step long")
    assert batch_log.append(rows, path, "q", 0) and batch_log.append(rows, path, "q", 1)
    assert not batch_log.append(rows, path, "q", 1)
    assert batch_log.append(rows, path) and batch_log.append(rows, path, "r", 1)
    assert batch_log.lines(spark, path).count() == 40
    # A killed writer: rows without a commit, and half a fold.
    rows.write.json(f"{path}/data/q/2/dead")
    (tmp_path / "log/folds/1").mkdir(parents=True)
    assert batch_log.lines(spark, path).count() == 40
    # Two attempts that commit at once are one batch.
    rows.write.json(f"{path}/data/q/3/bbbb")
    rows.limit(3).write.json(f"{path}/data/q/3/aaaa")
    for attempt in ("bbbb", "aaaa"):
        assert folders.create_once(spark, f"{path}/commits/q/3.{attempt}")
    assert batch_log.lines(spark, path).count() == 43


def test_a_log_is_folded_beside_its_writer(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame([(i,) for i in range(10)], "step long").repartition(4)
    for k in range(3):
        batch_log.append(rows, path, "q", k)
    reader = batch_log.lines(spark, path)
    assert batch_log.fold(spark, path) == 1 and reader.count() == 30
    batch_log.append(rows, path, "q", 3)
    assert not batch_log.append(rows, path, "q", 2)  # folded, and tried again
    assert batch_log.lines(spark, path).count() == 40
    reader = batch_log.lines(spark, path)
    assert batch_log.fold(spark, path) == 2 and reader.count() == 40
    assert list(batch_log.committed(spark, path)) == ["q/3"]
    assert batch_log.fold(spark, path) == 2  # nothing new
    assert len(folders.names(spark, f"{path}/segments")) == 2
    assert batch_log.lines(spark, path).count() == 40
    with pytest.raises(PredictionLogError):
        batch_log.lines(spark, str(tmp_path / "none"))


def test_a_scored_batch_that_runs_twice_is_read_once(spark, log, data, model, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "log")
    log.coalesce(1).write.parquet(folder)
    requests = spark.readStream.schema(log.schema).parquet(folder)
    stored = store.build_offline(log)
    for _ in range(2):
        jobs.score_stream(requests, stored, model, "3", path, str(tmp_path / "checkpoint"))
        # As if the driver had died after the log was written, before the batch was done.
        for f in (tmp_path / "checkpoint/commits").iterdir():
            f.unlink()
    assert tables.read_prediction_log(spark, path).count() == 60


def test_production_scores_a_stream(spark, log, data, tmp_path):
    models_at, path = str(tmp_path / "models"), str(tmp_path / "log")
    log.write.parquet(str(tmp_path / "in"))
    requests = spark.readStream.schema(log.schema).parquet(str(tmp_path / "in"))
    stored = store.build_offline(log.where("step <= 30"))
    for _ in range(2):
        jobs.train(spark, data, models_at, specs=QUICK[:1])
    with pytest.raises(ModelError, match="Production"):
        jobs.score_with_production(spark, requests, stored, models_at, path, str(tmp_path / "c"))
    models.promote(spark, models_at, jobs.MODEL_NAME, "1")
    assert jobs.score_with_production(spark, requests, stored, models_at, path, str(tmp_path / "c")) == "1"
    logged = tables.read_prediction_log(spark, path)
    assert logged.count() == 30 and {r.model_version for r in logged.collect()} == {"1"}


def test_publish_counts(spark, log, row, tmp_path):
    counts = jobs.publish(log.unionByName(row(type="GIFT")), str(tmp_path / "wire")).first()
    assert (counts.sent, counts.skipped) == (60, 1)
    assert spark.read.text(str(tmp_path / "wire")).count() == 60


# ---- tables


def test_splits_round_trip(spark, data, tmp_path):
    path = str(tmp_path / "splits")
    tables.write_splits(data, path)
    back = tables.read_splits(spark, path)
    assert {r.split: r["count"] for r in back.groupBy("split").count().collect()} == {"train": 42, "validation": 9, "test": 9}
    plan = back.where("split = 'test'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(ModelError, match="preprocess"):
        tables.read_splits(spark, str(tmp_path / "absent"))
    partial = str(tmp_path / "partial")
    tables.write_splits(data.where("split <> 'test'"), partial)
    with pytest.raises(ModelError, match="test"):
        tables.read_splits(spark, partial)


def test_offline_features_round_trip(spark, log, tmp_path):
    path = str(tmp_path / "offline")
    view = store.build_offline(log)
    tables.write_offline_features(view, path)
    assert tables.read_offline_features(spark, path).exceptAll(view).isEmpty()
    with pytest.raises(FeatureError):
        tables.read_offline_features(spark, str(tmp_path / "absent"))
