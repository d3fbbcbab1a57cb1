"""The scheduled job chains; each is one Spark application."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.errors import QualityError, SplitError
from ledgerlens.functions.wire import record_problem
from ledgerlens.operators import drift, metrics, models, scoring, store
from ledgerlens.operators.prepare import add_features, encode, smallest
from ledgerlens.operators.split import TIME, temporal_split
from ledgerlens.operators.validation import split_classes, trainable
from ledgerlens.schema import LABEL, MODEL_INPUTS, TRANSACTION_SCHEMA
from ledgerlens.session import drop_path, scratch_path
from ledgerlens.sources import batch_log, tables
from ledgerlens.sources import log as log_source
from ledgerlens.streaming import jobs as stream_jobs
from ledgerlens.streaming import online

log = logging.getLogger(__name__)

NEGATIVES_IN_SAMPLE = 30_000
MODEL_NAME = "transaction-risk"
MATERIALIZED = "materialized"


def assert_trainable(df: DataFrame) -> None:
    row = trainable(df).first()
    if not row.has_rows:
        raise QualityError("the log is empty")
    if not row.has_positives:
        raise QualityError("the log has no positive rows to learn from")


def assert_split(split: DataFrame) -> None:
    bad = [r for r in split_classes(split).collect() if not r.usable]  # three rows
    if bad:
        raise SplitError("; ".join(f"{r.split}: {r.rows} rows, {r.classes} classes" for r in bad))


def processed(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Features, encoding and split of a raw log, as one plan; `keep` names row ids."""
    encoded = encode(add_features(raw))
    return temporal_split(encoded).select(*keep, *MODEL_INPUTS, LABEL, "split")


def preprocess(spark: SparkSession, csv_path: str, out: str) -> DataFrame:
    """Load, check, derive, encode, split, write; returns the written table.

    The checked log is kept as parquet in the shared folder while the job runs: the passes
    that follow read one column each, and only the last reads them all. The classes of
    every part are checked before the previous table is replaced.
    """
    staged = scratch_path(spark, "checked-log")
    try:
        log_source.read_log(spark, csv_path).write.parquet(staged)
        raw = spark.read.schema(TRANSACTION_SCHEMA).parquet(staged)
        assert_trainable(raw)
        assert_split(temporal_split(raw.select(TIME, LABEL)))
        tables.write_splits(processed(raw), out)
    finally:
        drop_path(spark, staged)
    return tables.read_splits(spark, out)


def materialize(
    spark: SparkSession, csv_path: str, offline: str, online_path: str, rows: int | None = None
) -> DataFrame:
    """The log, or its first rows, to the offline table; the newest per key to the online table."""
    raw = log_source.read_log(spark, csv_path, nrows=rows)
    tables.write_offline_features(store.build_offline(raw), offline)
    view = tables.read_offline_features(spark, offline)
    latest = store.materialize(view, store.materialize_window(raw))
    online.write_batch(latest, online_path, MATERIALIZED, online.next_batch(spark, online_path, MATERIALIZED))
    return online.read_online(spark, online_path)


def daily(
    spark: SparkSession, csv_path: str, splits: str, offline: str, online_path: str, rows: int | None = None
) -> DataFrame:
    """Ingest, validate, preprocess, materialize, then fold the online table's batches."""
    preprocess(spark, csv_path, splits)
    materialize(spark, csv_path, offline, online_path, rows)
    online.compact(spark, online_path)
    return online.read_online(spark, online_path)


def fold_log(spark: SparkSession, log_path: str) -> int:
    """Folds the prediction log's batches; may run beside the stream that writes them."""
    return batch_log.fold(spark, log_path)


def train(
    spark: SparkSession,
    data: DataFrame,
    folder: str,
    name: str = MODEL_NAME,
    specs: Sequence[models.ModelSpec] = models.MODEL_SPECS,
) -> str:
    """Fits and compares all specs, saves the runs and registers the best; its version."""
    runs = models.train_compare(data, specs)
    models.save_runs(runs, folder)
    saved = spark.read.parquet(f"{folder}/runs").where(
        F.col("run_id").isin(list(runs.run_ids.values()))
    )
    best = metrics.best_run(saved).first()
    return models.register(spark, folder, name, best.run_id)


def weekly(
    spark: SparkSession,
    csv_path: str,
    splits: str,
    folder: str,
    specs: Sequence[models.ModelSpec] = models.MODEL_SPECS,
) -> DataFrame:
    """Preprocess, train and register, then evaluate the newest version on test."""
    data = preprocess(spark, csv_path, splits)
    train(spark, data, folder, specs=specs)
    return models.evaluate_version(spark, data, folder, MODEL_NAME)


def profile_reference(spark: SparkSession, csv_path: str, profile_path: str, rows: int | None = None) -> None:
    """Profiles the training log, or its first rows, for the monthly comparisons."""
    reference = drift.reference_sample(log_source.read_log(spark, csv_path), rows)
    drift.write_profile(reference, profile_path)


def monthly(spark: SparkSession, log_path: str, profile_path: str, rule: str) -> DataFrame:
    """Drift of the prediction log against the stored profile; reads no training row."""
    current = tables.read_prediction_log(spark, log_path)
    log.info("prediction log holds %s rows", current.count())
    return drift.summary(drift.profile_drift(drift.read_profile(spark, profile_path), current, rule))


def sample(raw: DataFrame, key: str, negatives: int = NEGATIVES_IN_SAMPLE) -> DataFrame:
    """All positives and a fixed number of the rest, picked by a hash of the key."""
    digest = F.sha2(F.col(key).cast("string"), 256)
    leading = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    rest = smallest(raw.where(F.col(LABEL) != 1), negatives, [leading, digest, F.col(key)])
    return raw.where(F.col(LABEL) == 1).unionByName(rest)


def publish(log_table: DataFrame, path: str | None = None, **kafka: str) -> DataFrame:
    """Sends the rows that are wire records; one row: how many were sent and skipped."""
    counted = log_table.agg(
        F.count_if(record_problem().isNull()).alias("sent"), F.count_if(record_problem().isNotNull()).alias("skipped")
    )
    tables.write_wire(tables.wire_messages(log_table), path, **kafka)
    return counted


def score_stream(
    requests: DataFrame,
    stored: DataFrame,
    model: PipelineModel,
    version: str,
    log_path: str,
    checkpoint: str,
    order: Sequence[str] = MODEL_INPUTS,
) -> None:
    """Scores a stream of requests; every micro-batch is logged once, however often it is
    tried, and a log that cannot be written does not stop the scoring. Within a batch the
    lookup is a table join."""

    def write(rows: DataFrame, batch: int) -> None:
        served = scoring.score_requests(rows, stored, model, version, order)
        tables.append_log(served, log_path, online.run_of(rows.sparkSession), batch)

    stream_jobs.run_batches(requests, write, checkpoint)


def score_with_production(
    spark: SparkSession,
    requests: DataFrame,
    stored: DataFrame,
    folder: str,
    log_path: str,
    checkpoint: str,
    name: str = MODEL_NAME,
) -> str:
    """Scores a stream with the version that is in Production when it starts; its number.

    Refuses when none is: a newly trained version has to be promoted first.
    """
    version, order, model = models.production_model(spark, folder, name)
    score_stream(requests, stored, model, version, log_path, checkpoint, order)
    return version
