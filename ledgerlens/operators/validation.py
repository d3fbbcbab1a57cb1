"""Checks that read the data. Guards on columns and arguments sit with their jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.schema import LABEL, SPLITS, TRANSACTION_SCHEMA, TRANSACTION_TYPES

EXPECTED_TYPES = {f.name: f.dataType.simpleString() for f in TRANSACTION_SCHEMA.fields}
_INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def _misfits(field: T.StructField) -> Column:
    """How many values of a text column do not fit the field's type."""
    raw = F.col(field.name)
    number = raw.try_cast("double").isNotNull()
    if isinstance(field.dataType, T.LongType):
        fits = raw.rlike(_INTEGER) & raw.try_cast("bigint").isNotNull()
        return F.count_if(~F.coalesce(fits, F.lit(False)))
    if isinstance(field.dataType, T.DoubleType):
        return F.count_if(raw.isNotNull() & ~number)
    filled, numeric = F.count(raw), F.count_if(raw.isNotNull() & number)
    return F.when((filled > 0) & (filled == numeric), filled).otherwise(F.lit(0))


def dtype_counts(text_rows: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """One row: values per column that do not fit the log's type, and extra aggregates.

    Integer columns may hold no gaps and no decimals; decimal columns accept whole
    numbers and gaps; a text column fails when every value in it is a number.
    """
    counts = [_misfits(f).cast("long").alias(f.name) for f in TRANSACTION_SCHEMA.fields]
    return text_rows.agg(*counts, *extra)


def dtype_failures(text_rows: DataFrame) -> DataFrame:
    """(column, expected, failures) for the columns that do not fit."""
    cells = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("expected"), F.col(c).alias("failures"))
        for c, t in EXPECTED_TYPES.items()
    ]
    found = dtype_counts(text_rows).select(F.explode(F.array(*cells)).alias("r"))
    return found.select("r.*").where("failures > 0")


def unknown_type() -> Column:
    """True for a type outside the vocabulary, null included."""
    return ~F.coalesce(F.col("type").isin(*TRANSACTION_TYPES), F.lit(False))


def unexpected_types(df: DataFrame) -> DataFrame:
    """Type values outside the vocabulary, each once, sorted."""
    return df.where(unknown_type()).select("type").distinct().orderBy("type")


def trainable(df: DataFrame) -> DataFrame:
    """One row: has_rows, has_positives."""
    return df.agg(
        (F.count("*") > 0).alias("has_rows"),
        (F.coalesce(F.sum(LABEL), F.lit(0)) > 0).alias("has_positives"),
    )


def split_classes(split: DataFrame) -> DataFrame:
    """Rows and label classes of each expected part; an absent part counts zero."""
    found = split.groupBy("split").agg(
        F.count("*").alias("rows"),
        (F.max(F.when(F.col(LABEL) == 0, 1).otherwise(0)) + F.max(F.when(F.col(LABEL) == 1, 1).otherwise(0)))
        .cast("long")
        .alias("classes"),
    )
    expected = split.sparkSession.createDataFrame([(s,) for s in SPLITS], "split string")
    filled = expected.join(found, "split", "left").select(
        "split",
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"),
        F.coalesce("classes", F.lit(0).cast("long")).alias("classes"),
    )
    return filled.withColumn("usable", (F.col("rows") > 0) & (F.col("classes") >= 2))


def quarantine(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows without the error column, and bad rows with it."""
    good = parsed.where(F.col("error").isNull()).drop("error")
    bad = parsed.where(F.col("error").isNotNull())
    return good, bad
