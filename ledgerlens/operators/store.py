"""Offline and online feature tables as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.errors import FeatureError
from ledgerlens.operators.prepare import add_features, feature_view
from ledgerlens.schema import (
    BASE_DATE,
    ENTITY_KEY,
    EVENT_TIME,
    FEATURE_NAMES,
    FEATURE_TTL_DAYS,
    FEATURE_VIEW_SCHEMA,
    SOURCE_OFFSET,
    WRITTEN_AT,
)


def latest_per_key(rows: DataFrame, key: str = ENTITY_KEY) -> DataFrame:
    """One row per key: the newest by event time, then by write time, then the last sent.

    `source_offset` is the place of a message in its source, so the last write wins and a
    replay gives the same rows. An aggregate, so copies of a hot key shrink before the
    shuffle. Only rows that tie on all of these are ordered by their values.
    """
    others = [c for c in rows.columns if c != key]
    clocks = [c for c in (EVENT_TIME, WRITTEN_AT, SOURCE_OFFSET) if c in others]
    newest = F.max(F.struct(*clocks, *[c for c in others if c not in clocks]))
    return rows.groupBy(key).agg(newest.alias("r")).select(*[key if c == key else f"r.{c}" for c in rows.columns])


def within_ttl(rows: DataFrame, as_of: Column, days: int = FEATURE_TTL_DAYS) -> DataFrame:
    return rows.where(F.col(EVENT_TIME) >= as_of - F.make_dt_interval(F.lit(days)))


def build_offline(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Feature view rows of a raw log; the result must match the declared view.

    Columns in `keep` (the source offset) are carried along.
    """
    view = feature_view(add_features(raw), keep)
    got = [(f.name, f.dataType) for f in view.schema.fields if f.name not in keep]
    want = [(f.name, f.dataType) for f in FEATURE_VIEW_SCHEMA.fields]
    if got != want:
        raise FeatureError(f"feature view is {got}, expected {want}")
    return view


def materialize_window(raw: DataFrame, base: str = BASE_DATE) -> DataFrame:
    """One row: [start, end) of the event times a log can hold."""
    start = F.to_timestamp_ntz(F.lit(base))
    last = raw.agg((F.max("step") + 1).alias("hours"))
    days = F.floor(F.col("hours") / 24).cast("int")
    rest = F.pmod(F.col("hours"), F.lit(24).cast("long")).cast("int")
    return last.select(
        start.alias("window_start"), (start + F.make_dt_interval(days, rest)).alias("window_end")
    )


def materialize(offline: DataFrame, window: DataFrame) -> DataFrame:
    """Online rows: the latest of each key inside the window."""
    inside = (
        offline.crossJoin(F.broadcast(window))  # one row
        .where((F.col(EVENT_TIME) >= F.col("window_start")) & (F.col(EVENT_TIME) < F.col("window_end")))
        .drop("window_start", "window_end")
    )
    return latest_per_key(inside)


def parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Feature rows found on one side only: (side, key, features); empty when equal."""
    columns = [ENTITY_KEY, *FEATURE_NAMES]
    a, b = left.select(*columns), right.select(*columns)
    return (
        a.exceptAll(b)
        .withColumn("side", F.lit("left"))
        .unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
    )


def parity_counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: rows that agree, rows only left, rows only right; one shuffle."""
    columns = [ENTITY_KEY, *FEATURE_NAMES]
    both = (
        left.select(*columns, F.lit(1).alias("a"), F.lit(0).alias("b"))
        .unionByName(right.select(*columns, F.lit(0).alias("a"), F.lit(1).alias("b")))
        .groupBy(*columns)
        .agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("long")

    return both.agg(
        total(F.least("a", "b")).alias("equal_rows"),
        total(F.greatest(F.col("a") - F.col("b"), F.lit(0))).alias("only_left"),
        total(F.greatest(F.col("b") - F.col("a"), F.lit(0))).alias("only_right"),
    )
