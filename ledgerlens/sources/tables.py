"""Parquet and JSON tables: splits, offline features, wire messages, prediction log."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.errors import FeatureError, ModelError, PredictionLogError
from ledgerlens.functions.wire import record_problem, wire_json
from ledgerlens.operators.models import check_splits
from ledgerlens.operators.prepare import head_sample
from ledgerlens.operators.scoring import log_rows
from ledgerlens.schema import FEATURE_VIEW_SCHEMA, PREDICTION_LOG_SCHEMA
from ledgerlens.sources import batch_log

log = logging.getLogger(__name__)


def write_splits(split: DataFrame, path: str) -> None:
    """One folder per split; readers of one split skip the others."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    try:
        data = spark.read.parquet(path)
    except AnalysisException as error:
        raise ModelError(f"no processed data at {path}; run the preprocess job first") from error
    if "split" not in data.columns:
        raise ModelError(f"{path} is not divided into splits")
    check_splits(data)
    return data


def write_offline_features(view: DataFrame, path: str) -> None:
    view.write.mode("overwrite").parquet(path)


def read_offline_features(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(FEATURE_VIEW_SCHEMA).parquet(path)
    except AnalysisException as error:
        raise FeatureError(f"no offline features at {path}") from error


def wire_messages(
    log: DataFrame, limit: int | None = None, order: tuple[str, ...] | None = None
) -> DataFrame:
    """One JSON message per row of the log, or of its first rows, without the label.

    Rows that are no wire record are skipped.
    """
    rows = log if limit is None else head_sample(log, limit, order)
    return rows.where(record_problem().isNull()).select(wire_json().alias("value"))


def write_wire(messages: DataFrame, path: str | None = None, **kafka: str) -> None:
    """To text files, or to Kafka when its options (servers, topic) are given."""
    if kafka:
        messages.write.format("kafka").options(**kafka).save()
    else:
        messages.write.mode("append").text(path)


def append_log(scored: DataFrame, path: str, run: str | None = None, batch: int = 0) -> bool:
    """Best effort: a log that cannot be written never fails the scoring.

    A stream names its run and batch, and a batch that was logged before is not logged
    again. Rows that cannot be made (a wrong column, a failing expression) are errors as
    ever: only what the writer's file system says is swallowed.
    """
    rows = log_rows(scored)
    try:
        batch_log.append(rows, path, run, batch)
    except (PySparkException, Py4JJavaError) as error:
        if not _is_write_failure(error):
            raise
        log.exception("prediction log %s was not written", path)
        return False
    return True


def _is_write_failure(error: Exception) -> bool:
    """Whether a Java I/O exception is the cause."""
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    while java is not None:
        name = java.getClass().getName()
        if name.startswith(("java.io.", "java.nio.file.", "org.apache.hadoop.fs.", "org.apache.hadoop.security.")):
            return True
        java = java.getCause()
    return False


def read_prediction_log(spark: SparkSession, path: str) -> DataFrame:
    """Logged predictions; blank lines are skipped, an absent or empty log is refused.

    Of a log of batches only what is committed; else the path is files of JSON lines. A
    line that is no log record ends the job that reads it.
    """
    try:
        # Read as text first: a blank line would come out of the JSON reader as nulls.
        lines = batch_log.lines(spark, path) if batch_log.is_log(spark, path) else spark.read.text(path)
        lines = lines.where(F.length(F.trim("value")) > 0)
    except AnalysisException as error:
        raise PredictionLogError(f"nothing is logged at {path}") from error
    rows = lines.select(F.from_json("value", PREDICTION_LOG_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    if lines.isEmpty():
        raise PredictionLogError(f"the prediction log at {path} is empty")
    return rows
