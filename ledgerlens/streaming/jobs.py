"""Streaming jobs: features, status, first valid messages, live windows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.features import entity_id, finite
from ledgerlens.functions.wire import parse_wire
from ledgerlens.operators import monitoring
from ledgerlens.operators.prepare import add_features, feature_view
from ledgerlens.schema import ENTITY_KEY, NUMERIC_COLUMNS, SOURCE_OFFSET
from ledgerlens.streaming import online

OK, SKIPPED = "OK", "SKIPPED"


def with_features(parsed: DataFrame) -> DataFrame:
    """Adds the features to parsed messages; a good one without finite money gets an error.

    The expressions are those of the batch job, so both give the same values.
    """
    failed = F.coalesce(
        *[F.when(finite(F.col(n)).isNull(), F.lit(f"processing:{n}")) for n in NUMERIC_COLUMNS]
    )
    return add_features(parsed.withColumn("error", F.coalesce("error", failed)))


def feature_rows(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages to feature view rows; bad messages are left out."""
    good = with_features(parse_wire(messages)).where(F.col("error").isNull())
    return feature_view(good, keep)


def status_rows(messages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per message: OK or SKIPPED, why, and for which entity.

    `invalid` is a message that does not parse, `processing` one whose features fail.
    """
    return _status(with_features(parse_wire(messages)), keep)


def _status(done: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    kind = F.when(F.col("error").startswith("processing"), "processing").when(
        F.col("error").isNotNull(), "invalid"
    )
    return done.select(
        *keep,
        F.when(F.col("error").isNull(), OK).otherwise(SKIPPED).alias("status"),
        kind.alias("kind"),
        F.col("error").alias("reason"),
        F.when(F.col("error").isNull() | F.col("error").startswith("processing"), entity_id()).alias(ENTITY_KEY),
    )


def worker(online_path: str, status_path: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: features of the good messages into the online table, and
    one status per message, from one parse. A batch that fails is retried as a whole; both
    writes replace what an earlier try left.

    `messages` have `value` and, where the source has one, `source_offset`.
    """

    def write(messages: DataFrame, batch: int) -> None:
        run = online.run_of(messages.sparkSession)
        done = with_features(parse_wire(online.with_offset(messages, batch))).persist()
        try:
            good = feature_view(done.where(F.col("error").isNull()), (SOURCE_OFFSET,))
            online.write_batch(good, online_path, run, batch)
            told = _status(done, (SOURCE_OFFSET,))
            told.write.mode("overwrite").parquet(f"{status_path}/run={run}/batch={batch}")
        finally:
            done.unpersist()

    return write


def read_status(spark: SparkSession, status_path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", "true").parquet(status_path)


def first_valid(messages: DataFrame, n: int, order: tuple[str, ...]) -> DataFrame:
    """The first n messages that parse, by offset."""
    good = parse_wire(messages).where(F.col("error").isNull()).drop("error")
    return good.orderBy(*order).limit(n)


def run_bounded(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Writes all that is available now to parquet, exactly once, and ends."""
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .outputMode("append")
        .start(path)
    )
    query.awaitTermination()


def run_batches(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True
):
    """Hands every micro-batch to `write`; returns the running query when unbounded."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    if not once:
        return writer.start()
    writer.trigger(availableNow=True).start().awaitTermination()
    return None


def live_windows(log: DataFrame, delay: str = "10 minutes", panel=monitoring.request_rate, **settings) -> DataFrame:
    """A panel over a growing log: a window is final once the watermark passes it."""
    timed = log.withColumn("logged_at", F.col("logged_at").cast("timestamp"))
    return panel(timed.withWatermark("logged_at", delay), **settings)
