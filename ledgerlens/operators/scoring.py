"""Scoring: raw fields joined to stored features, never recomputed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import entity_id, type_indicators
from ledgerlens.functions.wire import record_problem, request_problem
from ledgerlens.operators.prepare import reindex
from ledgerlens.schema import (
    ENTITY_KEY,
    FEATURE_NAMES,
    MODEL_INPUTS,
    PREDICTION_LOG_SCHEMA,
)

SUCCESS = "success"
INVALID = "invalid_request"
UNAVAILABLE = "features_unavailable"
# Refused at the boundary, before a request is counted; never in the request counters.
MALFORMED = "malformed"
NOT_READY = "not_ready"
COUNTED = (SUCCESS, INVALID, UNAVAILABLE)

STREAM_SLICES = 8


def _no_features() -> Column:
    absent = F.lit(True)
    for name in FEATURE_NAMES:
        absent = absent & F.col(name).isNull()
    return absent


def _keyed(requests: DataFrame) -> DataFrame:
    return requests if ENTITY_KEY in requests.columns else requests.withColumn(ENTITY_KEY, entity_id())


def _join_by_key(keyed: DataFrame, stored: DataFrame, how: str) -> DataFrame:
    """Joins requests to one stored row per key; both sides grow with the log.

    One shuffle of either side, with the key computed once. Requests of hot keys make
    large shuffle partitions, however many such keys there are; Spark's skew-join rule
    cuts the request side of every partition beyond five times the median (and beyond
    `spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes`) into several tasks.
    That rule does not reach into a stream, so there the requests of every key are dealt
    to `STREAM_SLICES` slices, in each of which the stored rows are repeated.
    """
    if not keyed.isStreaming:
        return keyed.join(stored, ENTITY_KEY, how)
    others = [c for c in keyed.columns if c != ENTITY_KEY]
    dealt = keyed.withColumn("_slice", F.pmod(F.xxhash64(*others), F.lit(STREAM_SLICES)).cast("int"))
    repeated = stored.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(STREAM_SLICES - 1))))
    return dealt.join(repeated, [ENTITY_KEY, "_slice"], how).drop("_slice")


def lookup(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests with their stored features, null where none are stored.

    `stored` has one row per key.
    """
    return _join_by_key(_keyed(requests), stored.select(ENTITY_KEY, *FEATURE_NAMES), "left")


def missing_features(requests: DataFrame, stored: DataFrame) -> DataFrame:
    """Requests without a stored row, or whose stored features are all null."""
    present = stored.where(~_no_features()).select(ENTITY_KEY)
    return _join_by_key(_keyed(requests), present, "left_anti")


def outcome_column(ready: Column | None = None) -> Column:
    """Outcome of a looked-up request, in the order in which a service decides it.

    No model yet, then a request of the wrong shape (both uncounted), then one that is no
    transaction record, then one without stored features.
    """
    return (
        F.when(~(F.lit(True) if ready is None else ready), NOT_READY)
        .when(request_problem().isNotNull(), MALFORMED)
        .when(record_problem().isNotNull(), INVALID)
        .when(_no_features(), UNAVAILABLE)
        .otherwise(SUCCESS)
    )


def outcomes(requests: DataFrame, stored: DataFrame, ready: Column | None = None) -> DataFrame:
    """Requests with `outcome` and, for those of the wrong shape, `reason`.

    `ready` tells per request whether a model was loaded; without it one always was.
    """
    found = lookup(requests, stored)
    outcome = outcome_column(ready)
    reason = F.when(outcome.isin(MALFORMED, INVALID), request_problem())
    return found.withColumns({"outcome": outcome, "reason": reason}).select(
        *[c for c in found.columns if c not in FEATURE_NAMES], "outcome", "reason"
    )


def score_vectors(df: DataFrame, model: PipelineModel, version: str) -> DataFrame:
    """Adds prediction, fraud_probability and model_version; drops the vectors."""
    scored = model.transform(df)
    made = [c for c in scored.columns if c not in df.columns]
    return (
        scored.withColumn("_class", F.col("prediction").cast("long"))
        .withColumn("_probability", F.get(vector_to_array("probability"), 1))
        .drop(*made)
        .withColumnsRenamed({"_class": "prediction", "_probability": "fraud_probability"})
        .withColumn("model_version", F.lit(version))
    )


def score_requests(
    requests: DataFrame,
    stored: DataFrame,
    model: PipelineModel,
    version: str,
    order: Sequence[str] = MODEL_INPUTS,
) -> DataFrame:
    """Served requests: every request column, then class, probability and version.

    `order` is what the model was trained on.
    """
    found = lookup(requests, stored).where(outcome_column() == SUCCESS)
    names = [c for c in found.columns if c not in FEATURE_NAMES]
    inputs = found.withColumns(type_indicators())
    # The trained order is restated here, so an input the model knows but the request
    # lacks becomes 0 rather than an error.
    ordered = reindex(inputs, order, keep=[n for n in names if n not in order])
    scored = score_vectors(ordered, model, version)
    return scored.select(*names, "prediction", "fraud_probability", "model_version")


def result_row(scored: DataFrame, truth: str = "truth") -> DataFrame:
    """Prediction beside truth, rounded for display; `correct` is null when unscored."""
    return scored.withColumns(
        {
            "fraud_probability": F.round("fraud_probability", 6),
            "latency_ms": F.round("latency_ms", 2),
            "correct": F.col("prediction") == F.col(truth),
        }
    )


def log_rows(scored: DataFrame) -> DataFrame:
    """Rows of the prediction log; `logged_at` is ISO text in UTC."""
    now = F.date_format(
        F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
    )
    known = scored if "logged_at" in scored.columns else scored.withColumn("logged_at", now)
    return known.select(*[F.col(f.name).cast(f.dataType) for f in PREDICTION_LOG_SCHEMA.fields])
