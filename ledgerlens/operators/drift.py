"""Drift of a current table against a reference table, column by column.

One row per distinct value carries both counts, so every statistic of a column comes
from a single shuffle of pre-aggregated counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.errors import DriftError
from ledgerlens.functions.features import finite
from ledgerlens.functions.pvalues import add_p_values
from ledgerlens.operators.prepare import head_sample
from ledgerlens.operators.running import running_totals
from ledgerlens.schema import DRIFT_CATEGORIES, DRIFT_COLUMNS, DRIFT_NUMBERS
from ledgerlens.session import scratch_path

# When a test or a distance calls a column drifted.
P_LIMIT = 0.05
DISTANCE_LIMIT = 0.1
SMALLEST_SPREAD = 0.001

TESTS, DISTANCES = "tests", "distances"
PROFILE_SCHEMA = "column string, value double, text string, rows long, numeric boolean"


def reference_sample(raw: DataFrame, n: int | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """The compared columns of the whole log, or of its first n rows."""
    return (raw if n is None else head_sample(raw, n, order)).select(*DRIFT_COLUMNS)


def _tidy(df: DataFrame, columns: Sequence[str], side: str, numeric: bool) -> DataFrame:
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            (finite(F.col(c).cast("double")) if numeric else F.col(c).cast("string")).alias("value"),
        )
        for c in columns
    ]
    rows = df.select(F.explode(F.array(*cells)).alias("r")).select("r.*").where("value IS NOT NULL")
    ones = {"reference": F.lit(0), "current": F.lit(0)}
    ones[side] = F.lit(1)
    return rows.select("column", "value", *[n.cast("long").alias(k) for k, n in ones.items()])


def value_counts(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], numeric: bool = True
) -> DataFrame:
    """(column, value, reference, current): counts of each distinct value on each side.

    Values are numbers, or with `numeric` off the texts of categories.
    """
    return (
        _tidy(reference, columns, "reference", numeric)
        .unionByName(_tidy(current, columns, "current", numeric))
        .groupBy("column", "value")
        .agg(F.sum("reference").alias("reference"), F.sum("current").alias("current"))
    )


# ---- a stored reference


def reference_profile(
    reference: DataFrame, numbers: Sequence[str] = DRIFT_NUMBERS, categories: Sequence[str] = DRIFT_CATEGORIES
) -> DataFrame:
    """(column, numeric, value, text, rows): how often each value of a compared column occurs.

    All that a comparison needs of the reference, which need not be read again.
    """
    parts = []
    for columns, numeric in ((numbers, True), (categories, False)):
        if columns:
            counted = _tidy(reference, columns, "reference", numeric).groupBy("column", "value").agg(F.sum("reference").alias("rows"))
            value = F.col("value") if numeric else F.lit(None).cast("double")
            text = F.lit(None).cast("string") if numeric else F.col("value")
            parts.append(counted.select("column", F.lit(numeric).alias("numeric"), value.alias("value"), text.alias("text"), "rows"))
    if not parts:
        raise DriftError("no columns to compare")
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def write_profile(reference: DataFrame, path: str, **columns: Sequence[str]) -> None:
    """Numbers and categories in folders of their own, so a comparison of one skips the other."""
    reference_profile(reference, **columns).write.mode("overwrite").partitionBy("numeric").parquet(path)


def read_profile(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(PROFILE_SCHEMA).parquet(path)
    except AnalysisException as error:
        raise DriftError(f"no reference profile at {path}") from error


def merged_counts(profile: DataFrame, current: DataFrame, columns: Sequence[str], numeric: bool = True) -> DataFrame:
    """`value_counts` with the reference side from its profile."""
    value = F.col("value" if numeric else "text")
    known = profile.where((F.col("numeric") == numeric) & F.col("column").isin(*columns))
    stored = known.select("column", value.alias("value"), F.col("rows").alias("reference"), F.lit(0).cast("long").alias("current"))
    both = stored.unionByName(_tidy(current, columns, "current", numeric)).groupBy("column", "value")
    return both.agg(F.sum("reference").alias("reference"), F.sum("current").alias("current"))


def _share_columns() -> tuple[Column, Column]:
    p = F.try_divide(F.col("reference").cast("double"), F.col("reference_total"))
    q = F.try_divide(F.col("current").cast("double"), F.col("current_total"))
    return p, q


def _category_statistics() -> dict[str, Column]:
    """Sums over categories: chi-square, Jensen-Shannon and the shares of one value."""
    p, q = _share_columns()
    expected = p * F.col("current_total")
    gap = F.col("current") - expected
    unseen = (F.col("reference") == 0) & (F.col("current") > 0)
    chi = F.when(unseen, F.lit(float("inf"))).otherwise(F.coalesce(F.try_divide(gap * gap, expected), F.lit(0.0)))
    middle = (p + q) / 2

    def divergence(share: Column) -> Column:
        return F.when(share > 0, share * F.ln(share / middle)).otherwise(F.lit(0.0))

    js = F.greatest(F.sum(divergence(p) + divergence(q)) / 2, F.lit(0.0))
    return {
        "distinct_values": F.count("*"),
        "reference_rows": F.max("reference_total"),
        "current_rows": F.max("current_total"),
        "chi2": F.sum(chi),
        "js": F.sqrt(js),
        "reference_share": F.max_by(p, "value"),
        "current_share": F.max_by(q, "value"),
    }


def category_statistics(counts: DataFrame) -> DataFrame:
    """Chi-square and Jensen-Shannon per column; columns are a fixed handful."""
    totals = counts.groupBy("column").agg(
        F.sum("reference").alias("reference_total"), F.sum("current").alias("current_total")
    )
    joined = counts.join(F.broadcast(totals), "column")
    return joined.groupBy("column").agg(*[c.alias(n) for n, c in _category_statistics().items()])


def number_statistics(counts: DataFrame, distance: bool = True) -> DataFrame:
    """Category statistics plus KS distance and, with `distance`, the spread-normalised
    Wasserstein distance (else null).

    The counts are written to the shared folder first: cuts, ranges, totals and spread all
    read them, and the tables they come from only once.
    """
    path = scratch_path(counts.sparkSession, "value-counts")
    counts.write.parquet(path)
    counts = counts.sparkSession.read.schema(counts.schema).parquet(path)
    run = running_totals(counts, "value", ["reference", "current"], ["column"], following=True)
    f = (F.col("reference_before") + F.col("reference")) / F.col("reference_total")
    g = (F.col("current_before") + F.col("current")) / F.col("current_total")
    gap = F.abs(f - g)
    area = F.sum(F.when(F.col("_next").isNotNull(), gap * (F.col("_next") - F.col("value"))))
    stats = run.groupBy("column").agg(
        F.max(gap).alias("ks"),
        F.coalesce(area, F.lit(0.0)).alias("area"),
        *[c.alias(n) for n, c in _category_statistics().items()],
    )
    if not distance:
        return stats.withColumn("wasserstein", F.lit(None).cast("double")).drop("area")
    middle = counts.groupBy("column").agg(
        F.try_divide(F.sum(F.col("reference") * F.col("value")), F.sum("reference")).alias("mean")
    )
    away = F.col("value") - F.col("mean")
    spread = (
        counts.join(F.broadcast(middle), "column")  # one row per column
        .groupBy("column")
        .agg(F.sqrt(F.try_divide(F.sum(F.col("reference") * away * away), F.sum("reference"))).alias("spread"))
    )
    normalised = F.col("area") / F.greatest(F.col("spread"), F.lit(SMALLEST_SPREAD))
    return (
        stats.join(F.broadcast(spread), "column")  # one row per column
        .withColumn("wasserstein", normalised)
        .drop("area", "spread")
    )


def ks_distance(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    return number_statistics(value_counts(reference, current, columns), distance=False).select(
        "column", "reference_rows", "current_rows", F.col("ks").alias("statistic")
    )


def wasserstein_distance(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    return number_statistics(value_counts(reference, current, columns)).select(
        "column", F.col("wasserstein").alias("statistic")
    )


def chi_square(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = category_statistics(value_counts(reference, current, columns, numeric=False))
    return stats.select(
        "column", F.col("chi2").alias("statistic"), (F.col("distinct_values") - 1).alias("freedom")
    )


def js_distance(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    stats = category_statistics(value_counts(reference, current, columns, numeric=False))
    return stats.select("column", F.col("js").alias("statistic"))


def column_drift(
    reference: DataFrame,
    current: DataFrame,
    rule: str,
    numbers: Sequence[str] = DRIFT_NUMBERS,
    categories: Sequence[str] = DRIFT_CATEGORIES,
    exact: bool = False,
) -> DataFrame:
    """(column, test, statistic, p_value, drifted, ...), one row per column.

    The caller says how the columns are compared, whatever the tables' sizes are: `TESTS`
    by p-value (numbers by KS, categories by chi-square, two categories by a proportion
    test), `DISTANCES` by Wasserstein and Jensen-Shannon distance; and which columns are
    numbers and which categories. `exact` asks for the KS p-value of small samples by
    counting paths, which takes time in proportion to the product of the row counts.
    """
    return _compared(lambda c, numeric: value_counts(reference, current, c, numeric), rule, numbers, categories, exact)


def profile_drift(
    profile: DataFrame,
    current: DataFrame,
    rule: str,
    numbers: Sequence[str] = DRIFT_NUMBERS,
    categories: Sequence[str] = DRIFT_CATEGORIES,
    exact: bool = False,
) -> DataFrame:
    """`column_drift` against a stored profile of the reference."""
    return _compared(lambda c, numeric: merged_counts(profile, current, c, numeric), rule, numbers, categories, exact)


def _compared(
    counts_of: Callable[[Sequence[str], bool], DataFrame],
    rule: str,
    numbers: Sequence[str],
    categories: Sequence[str],
    exact: bool,
) -> DataFrame:
    if rule not in (TESTS, DISTANCES):
        raise DriftError(f"unknown drift rule {rule!r}")
    parts = []
    if numbers:
        found = number_statistics(counts_of(numbers, True), distance=rule == DISTANCES)
        parts.append(found.withColumn("numeric", F.lit(True)))
    if categories:
        stats = category_statistics(counts_of(categories, False))
        parts.append(
            stats.withColumns(
                {
                    "ks": F.lit(None).cast("double"),
                    "wasserstein": F.lit(None).cast("double"),
                    "numeric": F.lit(False),
                }
            )
        )
    if not parts:
        raise DriftError("no columns to compare")
    stats = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    if rule == DISTANCES:
        test = F.when(F.col("numeric"), "wasserstein").otherwise("js")
    else:
        test = F.when(F.col("numeric"), "ks").when(F.col("distinct_values") <= 2, "z").otherwise("chi2")
    a, b = F.col("reference_rows"), F.col("current_rows")
    p, q = F.col("reference_share"), F.col("current_share")
    pooled = (p * a + q * b) / (a + b)
    z = F.try_divide(p - q, F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(0.0)) * (1 / a + 1 / b)))
    chosen = stats.withColumn("test", test).withColumn("z", z)
    statistic = (
        F.when(F.col("test") == "ks", F.col("ks"))
        .when(F.col("test") == "z", F.col("z"))
        .when(F.col("test") == "chi2", F.col("chi2"))
        .when(F.col("test") == "js", F.col("js"))
        .otherwise(F.col("wasserstein"))
    )
    tidy = chosen.select(
        "column", "test", statistic.alias("statistic"), "reference_rows", "current_rows", "distinct_values"
    )
    if rule == DISTANCES:
        tested = tidy.withColumn("p_value", F.lit(None).cast("double"))
        drifted = F.col("statistic") >= DISTANCE_LIMIT
    else:
        # One row per compared column reaches Python.
        schema = T.StructType([*tidy.schema.fields, T.StructField("p_value", T.DoubleType())])
        tested = tidy.mapInPandas(lambda frames: add_p_values(frames, exact), schema)
        drifted = F.col("p_value") < P_LIMIT
    return tested.withColumn("drifted", F.coalesce(drifted, F.lit(False)))


def summary(per_column: DataFrame) -> DataFrame:
    return per_column.agg(
        F.count_if("drifted").alias("drifted_columns"), F.count("*").alias("total_columns")
    ).withColumn("drift_share", F.col("drifted_columns") / F.col("total_columns"))
