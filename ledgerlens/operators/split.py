"""Chronological train / validation / test split on whole steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.errors import SplitError
from ledgerlens.operators.running import running_totals
from ledgerlens.schema import LABEL

TIME = "step"
TRAIN_SIZE = 0.7
VALIDATION_SIZE = 0.15


def cumulative_share(df: DataFrame) -> DataFrame:
    """(step, rows, share): rows of the step, share of all rows up to and with it."""
    steps = df.where(F.col(TIME).isNotNull()).groupBy(TIME).agg(F.count("*").alias("rows"))
    run = running_totals(steps, TIME, ["rows"])
    upto = (F.col("rows_before") + F.col("rows")).cast("double")
    return run.select(TIME, "rows", (upto / F.col("rows_total")).alias("share"))


def cutoffs(
    df: DataFrame, train_size: float = TRAIN_SIZE, validation_size: float = VALIDATION_SIZE
) -> DataFrame:
    """One row: the last step of train and the last step of validation."""
    share = cumulative_share(df)

    def first_reaching(limit: float):
        return F.min(F.when(F.col("share") >= F.lit(limit), F.col(TIME)))

    return share.agg(
        first_reaching(train_size).alias("train_end"),
        first_reaching(train_size + validation_size).alias("validation_end"),
    )


def temporal_split(
    df: DataFrame, train_size: float = TRAIN_SIZE, validation_size: float = VALIDATION_SIZE
) -> DataFrame:
    """Adds `split`; a step is never divided between two parts."""
    for column in (TIME, LABEL):
        if column not in df.columns:
            raise SplitError(f"cannot split without column {column!r}")
    if not 0 < train_size < 1:
        raise SplitError(f"train size must lie between 0 and 1: {train_size}")
    if not 0 < validation_size < 1 - train_size:
        raise SplitError(f"validation size {validation_size} leaves no room for a test part")
    limits = cutoffs(df, train_size, validation_size)
    part = (
        F.when(F.col(TIME) <= F.col("train_end"), "train")
        .when(F.col(TIME) <= F.col("validation_end"), "validation")
        .when(F.col(TIME) > F.col("validation_end"), "test")
    )
    return (
        df.crossJoin(F.broadcast(limits))  # one row
        .withColumn("split", part)
        .drop("train_end", "validation_end")
    )


def summary(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min(TIME).alias("first_step"),
        F.max(TIME).alias("last_step"),
        F.round(F.avg(F.col(LABEL).cast("double")), 6).alias("positive_rate"),
    )
