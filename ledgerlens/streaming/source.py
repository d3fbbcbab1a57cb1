"""Streaming sources. A bounded run uses the available-now trigger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.functions.wire import wire_json
from ledgerlens.schema import SOURCE_OFFSET
from ledgerlens.sources.events import EVENTS_SCHEMA, as_transactions, corrected, messages


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """Unbounded topic from its first offset; needs the Kafka connector on the cluster."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .selectExpr(
            "CAST(value AS STRING) AS value",
            "partition",
            "timestamp",
            # A key is always in one partition, so its offsets order its messages.
            f"offset AS {SOURCE_OFFSET}",
        )
    )


def text_messages(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """A folder of text files with one message per line."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)


def event_transactions(spark: SparkSession, sf_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """The events table as a file stream of transactions."""
    # The pattern takes a single file as well as a folder of part files.
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    events = reader.parquet(f"{sf_dir}/events.parque[t]")
    return as_transactions(events)


def corrected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Well-formed messages with their offsets; some keys are sent again with other values."""
    return corrected(event_transactions(spark, sf_dir)).select(SOURCE_OFFSET, wire_json().alias("value"))


def event_messages(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """The same as wire messages: good and malformed, or every row well formed."""
    rows = event_transactions(spark, sf_dir)
    return rows.select("event_id", wire_json().alias("value")) if clean else messages(rows)
