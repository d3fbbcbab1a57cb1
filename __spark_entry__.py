"""

The log queries read the whole events table through `ledgerlens.sources.events`; names
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from importlib.util import find_spec
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import oracles
from ledgerlens.functions import wire
from ledgerlens.functions.features import entity_id, event_timestamp
from ledgerlens.operators import (
    buckets,
    drift,
    metrics,
    models,
    monitoring,
    prepare,
    quality,
    scoring,
    split,
    store,
    validation,
    versions,
)
from ledgerlens.plans import jobs
from ledgerlens.schema import (
    DRIFT_NUMBERS,
    ENTITY_KEY,
    FEATURE_NAMES,
    LABEL,
    MODEL_INPUTS,
    NUMERIC_COLUMNS,
    SOURCE_OFFSET,
    TRANSACTION_SCHEMA,
)
from ledgerlens.session import scratch_path, shared_dir
from ledgerlens.sources import events, log, tables
from ledgerlens.streaming import jobs as stream_jobs
from ledgerlens.streaming import live, online, panels, source, state

Query = Callable[[SparkSession, str], DataFrame]
_REGISTERED: dict[str, Query] = {}


def query(make: Query) -> Query:
    _REGISTERED[make.__name__.strip("_")] = make
    return make


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Sums of doubles differ in the last bits between engines."""
    return df.withColumns({c: F.round(c, places) for c in columns})


def featured(spark: SparkSession, d: str) -> DataFrame:
    return prepare.add_features(events.transactions(spark, d))


def scored(spark: SparkSession, d: str) -> DataFrame:
    return events.with_scores(events.transactions(spark, d))


def outcome_log(spark: SparkSession, d: str) -> DataFrame:
    return events.outcome_log(events.transactions(spark, d))


def split_rows(spark: SparkSession, d: str) -> DataFrame:
    return split.temporal_split(featured(spark, d))


def csv_log(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "csv")
    events.raw_log(spark, d).write.option("header", True).csv(path)
    return path


def bounded(stream: DataFrame, name: str) -> DataFrame:
    """Runs a stream over all its input into a new table and reads that."""
    spark = stream.sparkSession
    path = scratch_path(spark, name)
    stream_jobs.run_bounded(stream, path, scratch_path(spark, f"{name}-checkpoint"))
    return spark.read.schema(stream.schema).parquet(path)


# ---- sources and sinks


@query
def src_csv(spark, d):
    return log.read_log(spark, csv_log(spark, d))


@query
def src_head_sample(spark, d):
    return prepare.head_sample(events.transactions(spark, d), 2000, ("step", "event_id")).select(
        "event_id", *TRANSACTION_SCHEMA.names
    )


@query
def sink_split_parquet(spark, d):
    path = scratch_path(spark, "splits")
    tables.write_splits(jobs.processed(events.raw_log(spark, d)), path)
    return split.summary(spark.read.parquet(path))


@query
def src_split_parquet(spark, d):
    path = scratch_path(spark, "splits")
    tables.write_splits(jobs.processed(events.raw_log(spark, d)), path)
    return tables.read_splits(spark, path)


@query
def sink_offline_features(spark, d):
    path = scratch_path(spark, "offline")
    tables.write_offline_features(store.build_offline(events.transactions(spark, d)), path)
    return spark.read.parquet(path).agg(
        F.count("*").alias("rows"), F.count_distinct(ENTITY_KEY).alias("keys")
    )


@query
def src_offline_features(spark, d):
    path = scratch_path(spark, "offline")
    tables.write_offline_features(store.build_offline(events.transactions(spark, d)), path)
    return tables.read_offline_features(spark, path)


@query
def src_stream(spark, d):
    return bounded(source.event_messages(spark, d).select("event_id"), "stream")


@query
def src_stream_bounded(spark, d):
    arrived = bounded(source.event_messages(spark, d), "stream")
    return arrived.agg(
        F.count("*").alias("messages"), F.count_distinct("event_id").alias("distinct_messages")
    )


@query
def src_stream_first_n(spark, d):
    arrived = bounded(source.event_messages(spark, d), "stream")
    return stream_jobs.first_valid(arrived, 1000, ("event_id",)).select(
        "event_id", "step", "type", "amount"
    )


@query
def sink_wire_json(spark, d):
    path = scratch_path(spark, "wire")
    jobs.publish(events.transactions(spark, d), path)
    parsed = wire.parse_wire(spark.read.text(path))
    return parsed.where("error IS NULL").drop("value", "error")


@query
def sink_prediction_log(spark, d):
    path = scratch_path(spark, "log")
    tables.append_log(prediction_rows(spark, d), path)
    tables.append_log(prediction_rows(spark, d), path)
    return tables.read_prediction_log(spark, path).agg(
        F.count("*").alias("rows"), F.count_distinct("logged_at").alias("times")
    )


@query
def src_prediction_log(spark, d):
    path = scratch_path(spark, "log")
    tables.append_log(prediction_rows(spark, d), path)
    return tables.read_prediction_log(spark, path)


def prediction_rows(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).select(
        "*",
        F.lit("1").alias("model_version"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("logged_at"),
    )


def _worked(spark: SparkSession, d: str) -> tuple[str, str]:
    """Runs the streaming worker over all messages; the online table and the status table."""
    online_path, status_path = scratch_path(spark, "online"), scratch_path(spark, "status")
    messages = source.event_messages(spark, d).withColumnRenamed("event_id", SOURCE_OFFSET)
    stream_jobs.run_batches(
        messages, stream_jobs.worker(online_path, status_path), scratch_path(spark, "worker-checkpoint")
    )
    return online_path, status_path


@query
def sink_status(spark, d):
    return stream_jobs.read_status(spark, _worked(spark, d)[1]).withColumnRenamed(SOURCE_OFFSET, "event_id")


# ---- validation


@query
def v2_dtypes(spark, d):
    k = F.col("k")
    text = events.transactions(spark, d).select(
        "k", *[F.col(c).cast("string").alias(c) for c in TRANSACTION_SCHEMA.names]
    )
    text = text.withColumns(
        {
            "amount": F.when(k == 0, F.lit("n/a")).otherwise(F.col("amount")),
            "step": F.when(k == 1, F.lit("1.5")).otherwise(F.col("step")),
            "isFraud": F.when(k != 2, F.col("isFraud")),
            "nameOrig": F.substring("nameOrig", 2, 20),
        }
    )
    return validation.dtype_failures(text)


@query
def v3_enum_domain(spark, d):
    return validation.unexpected_types(events.damaged(events.transactions(spark, d)))


@query
def v5_parse_transaction(spark, d):
    return wire.parse_wire(events.messages(events.transactions(spark, d))).drop("value")


@query
def v6_contract(spark, d):
    checked = wire.contract_violations(events.messages(events.transactions(spark, d)))
    return checked.select("event_id", F.array_join("violations", ",").alias("violations"))


@query
def v7_request_bounds(spark, d):
    return events.damaged(events.transactions(spark, d)).select(
        "event_id", wire.request_problem().alias("problem")
    )


@query
def v9_trainable(spark, d):
    return validation.trainable(events.raw_log(spark, d))


@query
def v11_split_classes(spark, d):
    return validation.split_classes(split_rows(spark, d))


@query
def v13_quarantine(spark, d):
    good, bad = validation.quarantine(wire.parse_wire(events.messages(events.transactions(spark, d))))
    counts = good.agg(F.count("*").alias("rows")).withColumn("reason", F.lit("accepted"))
    return counts.unionByName(
        bad.groupBy(F.col("error").alias("reason")).agg(F.count("*").alias("rows"))
    )


# ---- row-wise features


def _one_feature(name: str) -> Query:
    def run(spark, d):
        return featured(spark, d).select("event_id", name)

    return run


for _key, _feature in {
    "f_orig_balance_error": "orig_balance_error",
    "f_dest_balance_error": "dest_balance_error",
    "f_orig_balance_delta": "orig_balance_delta",
    "f_dest_balance_delta": "dest_balance_delta",
    "f_orig_depleted": "is_orig_balance_depleted",
    "f_dest_untouched": "is_dest_balance_untouched",
    "f_amount_ratio": "amount_to_orig_balance_ratio",
    "f_hour_of_day": "hour_of_day",
    "f_dest_merchant": "is_dest_merchant",
}.items():
    _REGISTERED[_key] = _one_feature(_feature)


@query
def feature_pipeline(spark, d):
    return featured(spark, d).drop("ts", "k")


@query
def feature_one(spark, d):
    rows = stream_jobs.feature_rows(source.event_messages(spark, d, clean=True), ("event_id",))
    return bounded(rows, "features").select("event_id", *FEATURE_NAMES)


@query
def drop_identifiers(spark, d):
    return prepare.drop_identifiers(events.transactions(spark, d).drop("ts", "k"))


@query
def one_hot_type(spark, d):
    return prepare.one_hot_type(events.transactions(spark, d).drop("ts", "k"))


@query
def bool_to_int(spark, d):
    t = events.transactions(spark, d)
    return prepare.bool_to_int(
        t.select("event_id", (F.col("amount") > 100).alias("large"), F.col("nameDest").startswith("M").alias("merchant"))
    )


@query
def reindex_features(spark, d):
    without = prepare.encode(featured(spark, d)).drop("type_DEBIT", "hour_of_day")
    return prepare.reindex(without, keep=["event_id"])


@query
def _entity_id(spark, d):
    return events.transactions(spark, d).select("event_id", entity_id().alias(ENTITY_KEY))


@query
def _event_timestamp(spark, d):
    return events.transactions(spark, d).select("event_id", event_timestamp().alias("event_timestamp"))


@query
def feature_view_rows(spark, d):
    return prepare.feature_view(featured(spark, d), keep=["event_id"])


@query
def to_wire(spark, d):
    return events.transactions(spark, d).select("event_id", wire.wire_struct().alias("w")).select("event_id", "w.*")


@query
def drop_label(spark, d):
    return events.transactions(spark, d).drop(LABEL, "ts", "k")


@query
def clip_upper_quantile(spark, d):
    return rounded(
        quality.clip_upper(events.transactions(spark, d)).select("event_id", "amount_clipped"), "amount_clipped"
    )


@query
def result_row(spark, d):
    return scoring.result_row(scored(spark, d)).select(
        "event_id", "nameOrig", "nameDest", "type", "amount", "truth", "prediction", "fraud_probability", "latency_ms", "correct"
    )


# ---- data quality


@query
def dq_overview(spark, d):
    return quality.overview(events.raw_log(spark, d))


@query
def dq_missing(spark, d):
    return quality.missing(events.gappy(events.transactions(spark, d)))


@query
def dq_duplicates(spark, d):
    t = events.transactions(spark, d)
    twice = t.unionByName(t.where("k = 0"))
    return quality.duplicates(twice.select(*TRANSACTION_SCHEMA.names))


@query
def dq_fraud_balance(spark, d):
    return quality.fraud_balance(events.raw_log(spark, d))


@query
def dq_type_counts(spark, d):
    return quality.type_counts(events.raw_log(spark, d))


@query
def dq_describe(spark, d):
    return rounded(quality.describe(events.raw_log(spark, d)), "value", places=8)


@query
def dq_negative_amount(spark, d):
    return quality.negative_amounts(events.damaged(events.transactions(spark, d)))


@query
def dq_label_counts(spark, d):
    return quality.label_counts(events.raw_log(spark, d))


@query
def dq_amount_histogram(spark, d):
    return rounded(quality.amount_histogram(events.raw_log(spark, d)), "bin_start")


@query
def dq_correlation(spark, d):
    return rounded(quality.correlation(events.raw_log(spark, d)), "correlation")


@query
def dq_report_tables(spark, d):
    return rounded(quality.report(events.gappy(events.transactions(spark, d))).drop("place"), "value")


# ---- temporal split


@query
def split_cumulative(spark, d):
    return split.cumulative_share(events.raw_log(spark, d))


@query
def split_cutoffs(spark, d):
    return split.cutoffs(events.raw_log(spark, d))


@query
def temporal_split(spark, d):
    return split.temporal_split(events.transactions(spark, d)).select("event_id", "step", "split")


@query
def split_summary(spark, d):
    return split.summary(split_rows(spark, d))


# ---- training set and models


@query
def dataset_xy(spark, d):
    data = models.assemble(jobs.processed(events.raw_log(spark, d)), MODEL_INPUTS)
    vector = vector_to_array("features")
    return rounded(
        data.groupBy("split", F.col(LABEL).alias("label")).agg(
            F.count("*").alias("rows"),
            F.max(F.size(vector)).cast("long").alias("inputs"),
            *[F.sum(F.get(vector, i)).alias(f"x{i}") for i in range(len(MODEL_INPUTS))],
        ),
        *[f"x{i}" for i in range(len(MODEL_INPUTS))],
        places=4,
    )


@query
def class_counts_weight(spark, d):
    return models.class_counts(split_rows(spark, d).where("split = 'train'"))


@query
def balanced_weights(spark, d):
    train = split_rows(spark, d).where("split = 'train'").select("event_id", LABEL)
    return models.balanced_weights(train)


@query
def standardize(spark, d):
    rows = split_rows(spark, d).select("event_id", "split", *NUMERIC_COLUMNS)
    return rounded(
        models.standardize(rows, rows.where("split = 'train'"), NUMERIC_COLUMNS), *NUMERIC_COLUMNS
    )


def _fitted(spark: SparkSession, d: str, spec: models.ModelSpec):
    data = jobs.processed(events.raw_log(spark, d))
    train = data.where("split = 'train'").persist()
    try:
        return data, models.fit(train, spec)
    finally:
        train.unpersist()


def _model(spec: models.ModelSpec) -> Query:
    """Fits one spec on train and evaluates it on the held-out splits."""

    def run(spark, d):
        data, model = _fitted(spark, d, spec)
        held_out = data.where("split <> 'train'").withColumnRenamed(LABEL, "truth")
        scored = models.score(held_out, model)
        sound = scored.groupBy("split").agg(F.bool_and(_sound_score()).alias("scores_sound"))
        return _facts(metrics.evaluate(scored, by=["split"]), "split").join(F.broadcast(sound), "split")  # two rows

    return run


def _sound_score():
    """Probability within 0 and 1, and the class that it says."""
    p, c = F.col("fraud_probability"), F.col("prediction")
    return p.between(0.0, 1.0) & (((p >= 0.5) & (c == 1)) | ((p <= 0.5) & (c == 0)))


def _facts(evaluated: DataFrame, *keys: str) -> DataFrame:
    """What must hold of a fitted model's metrics, whatever it learned."""
    negatives = F.col("true_negatives") + F.col("false_positives")
    positives = F.col("false_negatives") + F.col("true_positives")
    base = positives / (negatives + positives)
    return evaluated.select(
        *keys,
        negatives.alias("negatives"),
        positives.alias("positives"),
        F.col("average_precision").between(0.0, 1.0).alias("precision_in_range"),
        (F.col("average_precision") > base).alias("better_than_chance"),
    )


for _key, _spec in zip(("model_lr", "model_rf", "model_gbt_level", "model_gbt_leaf"), models.MODEL_SPECS):
    _REGISTERED[_key] = _model(_spec)


@query
def train_compare(spark, d):
    runs = models.train_compare(jobs.processed(events.raw_log(spark, d)))
    best = metrics.best_run(runs.metrics).select(F.col("average_precision").alias("chosen"))
    most = runs.metrics.where("split = 'validation'").agg(F.max("average_precision").alias("most"))
    right = best.crossJoin(most).select((F.col("chosen") == F.col("most")).alias("best_is_chosen"))
    return _facts(runs.metrics, "model", "split").crossJoin(F.broadcast(right))  # one row


@query
def score_batch(spark, d):
    _, model = _fitted(spark, d, models.MODEL_SPECS[0])
    rows = jobs.processed(events.transactions(spark, d), keep=("event_id",))
    test = rows.where("split = 'test'").withColumnRenamed(LABEL, "truth")
    return models.score(test, model, "1").select("event_id", "truth", _sound_score().alias("score_sound"), "model_version")


@query
def evaluate_latest(spark, d):
    folder = scratch_path(spark, "models")
    data = jobs.processed(events.raw_log(spark, d))
    jobs.train(spark, data, folder)
    return _facts(models.evaluate_version(spark, data, folder, jobs.MODEL_NAME))


# ---- evaluation metrics


@query
def m_confusion(spark, d):
    return metrics.confusion(scored(spark, d))


@query
def m_scores(spark, d):
    return rounded(metrics.scores(scored(spark, d)), *metrics.SCORES)


@query
def m_roc_auc(spark, d):
    return rounded(metrics.ranking(scored(spark, d)).select("roc_auc"), "roc_auc")


@query
def m_average_precision(spark, d):
    return rounded(metrics.ranking(scored(spark, d)).select("average_precision"), "average_precision")


@query
def m_as_rows(spark, d):
    return rounded(metrics.as_rows(metrics.evaluate(scored(spark, d)), "val_"), "value")


def rule_runs(spark: SparkSession, d: str) -> DataFrame:
    held_out = split_rows(spark, d).where("split <> 'train'")
    return metrics.evaluate(events.rule_scores(held_out), by=["model", "spec_order", "split"])


@query
def m_best_run(spark, d):
    return rounded(
        metrics.best_run(rule_runs(spark, d)).select("model", "average_precision", "roc_auc"),
        "average_precision",
        "roc_auc",
    )


@query
def m_comparison(spark, d):
    return rounded(metrics.comparison(rule_runs(spark, d)), "value")


# ---- model versions


@query
def reg_latest(spark, d):
    return versions.latest_versions(events.model_versions(events.transactions(spark, d)))


@query
def reg_production(spark, d):
    return versions.production_versions(events.model_versions(events.transactions(spark, d)))


# ---- scoring


@query
def score_lookup_join(spark, d):
    t = events.transactions(spark, d)
    return scoring.lookup(t, events.stored_features(t)).select("event_id", ENTITY_KEY, *FEATURE_NAMES)


@query
def score_lookup_buckets(spark, d):
    """The lookup of `score_lookup_join` with the stored rows in key buckets."""
    t, path = events.transactions(spark, d), scratch_path(spark, "buckets")
    buckets.write_buckets(events.stored_features(t), path, 16)
    found = buckets.lookup(t, buckets.read_buckets(spark, path))
    return found.select("event_id", ENTITY_KEY, *FEATURE_NAMES)


@query
def score_missing(spark, d):
    t = events.transactions(spark, d)
    return scoring.missing_features(t, events.stored_features(t)).select("event_id", ENTITY_KEY)


@query
def score_outcomes(spark, d):
    return outcome_log(spark, d).select("event_id", "outcome", "reason")


@query
def score_row(spark, d):
    t = events.transactions(spark, d)
    _, model = _fitted(spark, d, models.MODEL_SPECS[0])
    return scoring.score_requests(events.damaged(t), events.stored_features(t), model, "1").select(
        "event_id", _sound_score().alias("score_sound"), "model_version"
    )


@query
def score_log(spark, d):
    path = scratch_path(spark, "log")
    t = events.transactions(spark, d)
    _, model = _fitted(spark, d, models.MODEL_SPECS[0])
    requests = events.damaged(source.event_transactions(spark, d))
    jobs.score_stream(requests, events.stored_features(t), model, "1", path, scratch_path(spark, "score-checkpoint"))
    logged = tables.read_prediction_log(spark, path)
    return logged.groupBy("type", "model_version").agg(F.count("*").alias("rows"))


# ---- monitoring


@query
def mon_request_rate(spark, d):
    return rounded(monitoring.request_rate(outcome_log(spark, d)), "requests_per_second")


@query
def mon_latency_quantiles(spark, d):
    return rounded(monitoring.latency_quantiles(outcome_log(spark, d)), "p50", "p95", "p99", places=9)


@query
def mon_error_ratio(spark, d):
    return rounded(monitoring.error_ratio(outcome_log(spark, d)), "error_ratio")


@query
def mon_fraud_per_hour(spark, d):
    return monitoring.fraud_per_hour(outcome_log(spark, d))


@query
def mon_mean_probability(spark, d):
    return rounded(monitoring.mean_probability(outcome_log(spark, d)), "mean_probability", places=12)


@query
def mon_class_distribution(spark, d):
    return monitoring.class_distribution(outcome_log(spark, d))


@query
def mon_probability_histogram(spark, d):
    return monitoring.probability_histogram(outcome_log(spark, d))


@query
def mon_outcome_counters(spark, d):
    return monitoring.outcome_counters(outcome_log(spark, d))


@query
def mon_live_performance(spark, d):
    live = monitoring.live_performance(outcome_log(spark, d), events.transactions(spark, d))
    return rounded(live, *metrics.SCORES)


@query
def mon_rolling_accuracy(spark, d):
    results = scoring.result_row(scored(spark, d)).select("seq", "correct")
    return rounded(monitoring.rolling_accuracy(results), "rolling_accuracy")


@query
def mon_history_cap(spark, d):
    return monitoring.last_results(scoring.result_row(scored(spark, d))).select("seq", "truth", "prediction", "correct")


@query
def mon_recent(spark, d):
    return monitoring.last_results(scoring.result_row(scored(spark, d)), monitoring.RECENT_ROWS).select(
        "seq", "truth", "prediction", "correct"
    )


# ---- streaming and keyed state


@query
def st_features(spark, d):
    return bounded(stream_jobs.feature_rows(source.event_messages(spark, d), ("event_id",)), "features")


@query
def st_fault_isolation(spark, d):
    online_path, status_path = _worked(spark, d)
    counts = stream_jobs.read_status(spark, status_path).groupBy("status", "kind", "reason").agg(F.count("*").alias("rows"))
    served = online.read_online(spark, online_path).agg(F.count("*").alias("keys_served"))
    return counts.crossJoin(F.broadcast(served))  # one row


def _upsert(spark: SparkSession, d: str, path: str) -> None:
    rows = stream_jobs.feature_rows(source.corrected_messages(spark, d), (SOURCE_OFFSET,))
    stream_jobs.run_batches(rows, online.upsert_into(path), scratch_path(spark, "upsert-checkpoint"))


@query
def st_upsert_online(spark, d):
    path = scratch_path(spark, "online")
    _upsert(spark, d, path)
    return online.read_online(spark, path).drop("written_at", SOURCE_OFFSET)


@query
def st_latest_per_key(spark, d):
    view = store.build_offline(events.corrected(events.transactions(spark, d)), (SOURCE_OFFSET,))
    return store.latest_per_key(view).drop(SOURCE_OFFSET)


@query
def st_replay(spark, d):
    path = scratch_path(spark, "online")
    _upsert(spark, d, path)
    first = scratch_path(spark, "online-first")
    online.read_online(spark, path).write.parquet(first)
    _upsert(spark, d, path)
    return store.parity_counts(spark.read.parquet(first), online.read_online(spark, path))


@query
def st_ttl(spark, d):
    view = store.build_offline(events.transactions(spark, d))
    as_of = F.to_timestamp_ntz(F.lit("2034-01-12 00:00:00"))
    return store.within_ttl(view, as_of).select(ENTITY_KEY, "event_timestamp")


@query
def st_state_newest(spark, d):
    """The stream of `st_upsert_online` into a keyed state; the rows that the state holds."""
    rows = stream_jobs.feature_rows(source.corrected_messages(spark, d), (SOURCE_OFFSET,))
    checkpoint = scratch_path(spark, "state-checkpoint")
    state.keep_newest(rows, checkpoint)
    return state.read_newest(spark, checkpoint).drop(SOURCE_OFFSET)


@query
def st_windowed_monitoring(spark, d):
    outcomes = events.outcome_log(source.event_transactions(spark, d), events.stored_features(events.transactions(spark, d)))
    path = scratch_path(spark, "panels")
    stream_jobs.run_batches(outcomes, panels.write_into(path), scratch_path(spark, "panels-checkpoint"))
    return rounded(panels.request_rate(panels.read(spark, path)), "requests_per_second")


@query
def st_live_performance(spark, d):
    """Labels come up to nine days after their requests; those of a week and less count."""
    sent = source.event_transactions(spark, d)
    outcomes = events.outcome_log(sent, events.stored_features(events.transactions(spark, d)))
    labelled_at = F.col("ts") + F.make_dt_interval(F.pmod("event_id", F.lit(10)).cast("int"))
    labels = source.event_transactions(spark, d).select("event_id", "isFraud", labelled_at.alias("labelled_at"))
    path = scratch_path(spark, "live")
    # The files of the table are in no order of time, so no row of it may count as late.
    pairs = live.judged(outcomes, labels, "7 days", late="10000 days")
    stream_jobs.run_batches(pairs, live.write_into(path), scratch_path(spark, "live-checkpoint"))
    return rounded(live.read(spark, path).drop("expired"), *metrics.SCORES)


# ---- feature tables


@query
def fs_build_offline(spark, d):
    return store.build_offline(events.transactions(spark, d))


@query
def fs_materialize_window(spark, d):
    return store.materialize_window(events.transactions(spark, d))


@query
def fs_materialize(spark, d):
    t = events.transactions(spark, d)
    view = store.build_offline(events.corrected(t), (SOURCE_OFFSET, "k"))
    # Every fifth row's clock is ahead of the log, outside its window.
    ahead = F.col("event_timestamp") + F.expr("INTERVAL 60 DAYS")
    view = view.withColumn("event_timestamp", F.when(F.col("k") % 5 == 4, ahead).otherwise(F.col("event_timestamp")))
    return store.materialize(view.drop("k"), store.materialize_window(t)).drop(SOURCE_OFFSET)


@query
def fs_parity(spark, d):
    path = scratch_path(spark, "online")
    _upsert(spark, d, path)
    batch = store.latest_per_key(store.build_offline(events.corrected(events.transactions(spark, d)), (SOURCE_OFFSET,)))
    return store.parity_counts(batch, online.read_online(spark, path))


# ---- drift


def _train_and_test(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    rows = split.temporal_split(events.transactions(spark, d))
    return rows.where("split = 'train'"), rows.where("split = 'test'")


@query
def drift_reference(spark, d):
    return drift.reference_sample(events.transactions(spark, d), 5000, ("step", "event_id"))


@query
def drift_ks(spark, d):
    return rounded(drift.ks_distance(*_train_and_test(spark, d), DRIFT_NUMBERS), "statistic")


@query
def drift_chi2(spark, d):
    return rounded(drift.chi_square(*_train_and_test(spark, d), ("type",)), "statistic")


@query
def drift_wasserstein(spark, d):
    return rounded(drift.wasserstein_distance(*_train_and_test(spark, d), DRIFT_NUMBERS), "statistic")


@query
def drift_js(spark, d):
    return rounded(drift.js_distance(*_train_and_test(spark, d), ("type",)), "statistic")


@query
def drift_summary(spark, d):
    reference, current = _train_and_test(spark, d)
    shifted = current.withColumn("amount", F.col("amount") * 5)
    return drift.summary(drift.column_drift(reference, shifted, drift.DISTANCES))


@query
def drift_p_values(spark, d):
    tested = drift.column_drift(*_train_and_test(spark, d), drift.TESTS)
    return rounded(tested.select("column", "test", "statistic", "p_value", "drifted"), "statistic", "p_value")


# ---- job chains


@query
def job_preprocess(spark, d):
    return split.summary(jobs.preprocess(spark, csv_log(spark, d), scratch_path(spark, "splits")))


@query
def job_daily(spark, d):
    table = jobs.daily(
        spark,
        csv_log(spark, d),
        scratch_path(spark, "splits"),
        scratch_path(spark, "offline"),
        scratch_path(spark, "online"),
    )
    return table.select(ENTITY_KEY, "event_timestamp")


@query
def job_weekly(spark, d):
    evaluated = jobs.weekly(spark, csv_log(spark, d), scratch_path(spark, "splits"), scratch_path(spark, "models"))
    return _facts(evaluated)


@query
def job_monthly(spark, d):
    path = scratch_path(spark, "log")
    shifted = prediction_rows(spark, d).withColumn("amount", F.col("amount") * 5)
    tables.append_log(shifted, path)
    profile = scratch_path(spark, "profile")
    jobs.profile_reference(spark, csv_log(spark, d), profile)
    return jobs.monthly(spark, path, profile, drift.DISTANCES)


@query
def job_sample(spark, d):
    return jobs.sample(events.transactions(spark, d), "event_id", 2000).select("event_id", LABEL)


def entry(spark: SparkSession) -> DataFrame:
    """Log, features, time split and its summary at the smallest scale."""
    shared_dir(spark)
    return split_summary(spark, "/root/testdata/sf0.001")


def text_queries() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the text operators, where their subpackage is installed."""
    if find_spec("ledgerlens.llm") is None or find_spec("corpus_pipeline") is None:
        return {}, {}
    import corpus_pipeline
    from ledgerlens.llm.queries import ORACLE_SQL, QUERIES

    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE_SQL, **pipeline_sql}


def queries() -> dict[str, Query]:
    return {**_REGISTERED, **text_queries()[0]}


def oracle_sql() -> dict[str, str]:
    return {**oracles.statements(), **text_queries()[1]}
