"""Live quality where labels come later: served requests meet their labels in the stream.

A request waits in the state of a stream-stream join for a label that is known within a
bound of event time. Both sides have a watermark, so the state holds the requests and labels
of that bound and the lateness, not the whole log. A request whose time has passed leaves the
state as expired. Every micro-batch leaves one row of counts, as one committed batch; these
add up to the batch form `monitoring.live_performance` over the pairs within the bound.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.metrics import CONFUSION, confusion_cells, score_columns
from ledgerlens.operators.scoring import SUCCESS
from ledgerlens.sources import batch_log
from ledgerlens.streaming.online import run_of

COUNTS = (*CONFUSION, "expired")
_SCHEMA = ", ".join(f"{c} long" for c in COUNTS)


def judged(
    log: DataFrame, labels: DataFrame, within: str = "7 days", late: str = "1 hour", key: str = "event_id"
) -> DataFrame:
    """A stream of (key, prediction, truth, expired).

    `log` is an outcome log; `labels` has the key, `isFraud` and `labelled_at`. A label counts
    from the moment of its request to `within` after it. Every label of a request gives a row,
    as in the batch join; an expired request has none and no truth. Rows without a key or a
    time cannot be matched and are left out, as are rows later than `late`.
    """
    served = (
        log.where((F.col("outcome") == SUCCESS) & F.col(key).isNotNull() & F.col("logged_at").isNotNull())
        .select(key, "prediction", F.col("logged_at").cast("timestamp").alias("_asked"))
        .withWatermark("_asked", late)
    )
    known = (
        labels.where(F.col(key).isNotNull() & F.col("labelled_at").isNotNull())
        .select(F.col(key).alias("_key"), F.col("isFraud").alias("truth"), F.col("labelled_at").cast("timestamp").alias("_known"))
        .withWatermark("_known", late)
    )
    in_time = (F.col("_known") >= F.col("_asked")) & (F.col("_known") <= F.col("_asked") + F.expr(f"INTERVAL {within}"))
    joined = served.join(known, (F.col(key) == F.col("_key")) & in_time, "leftOuter")
    return joined.select(key, "prediction", "truth", F.col("_key").isNull().alias("expired"))


def write_into(path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function; a batch that is tried again is not added again."""

    def write(rows: DataFrame, batch: int) -> None:
        cells = [c.alias(n) for n, c in confusion_cells("truth", "prediction").items()]
        counts = rows.agg(*cells, F.count_if("expired").alias("expired"))
        if not batch_log.append(counts, path, run_of(rows.sparkSession), batch):
            counts.write.format("noop").mode("append").save()  # the state of the join moves on all the same

    return write


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row: the four cells, `scored`, `expired` and the scores, of all committed batches."""
    parts = batch_log.lines(spark, path).select(F.from_json("value", _SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    sums = parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS])
    scored = sum((F.col(c) for c in CONFUSION), F.lit(0).cast("long"))
    return sums.withColumn("scored", scored).withColumns(score_columns())
