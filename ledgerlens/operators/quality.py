"""Data quality report as tidy tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.running import exact_quantiles
from ledgerlens.schema import LABEL, NUMERIC_COLUMNS

HISTOGRAM_BINS = 50
CLIP_FRACTION = 0.99
CORRELATED = (*NUMERIC_COLUMNS, LABEL)


def long_form(row: DataFrame, names: dict[str, Column], key: str, value: str) -> DataFrame:
    """One wide row to (key, value) rows."""
    entries = [F.struct(F.lit(k).alias(key), c.alias(value)) for k, c in names.items()]
    return row.select(F.explode(F.array(*entries)).alias("r")).select("r.*")


def _positives() -> Column:
    return F.coalesce(F.sum(LABEL), F.lit(0)).cast("long")


def overview(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count")).withColumn(
        "column_count", F.lit(len(df.columns)).cast("long")
    )


def missing(df: DataFrame) -> DataFrame:
    """(column, missing) for columns with gaps."""
    gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return long_form(gaps, {c: F.col(c) for c in df.columns}, "column", "missing").where("missing > 0")


def duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    copies = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    return copies.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicate_rows")
    )


def fraud_balance(df: DataFrame) -> DataFrame:
    share = F.try_divide(F.lit(100.0) * F.col("fraud_count"), F.col("row_count"))
    return df.agg(_positives().alias("fraud_count"), F.count("*").alias("row_count")).select(
        "fraud_count", F.coalesce(F.round(share, 4), F.lit(0.0)).alias("fraud_percentage")
    )


def type_counts(df: DataFrame) -> DataFrame:
    known = df.where(F.col("type").isNotNull())
    return known.groupBy("type").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "type")


def label_counts(df: DataFrame) -> DataFrame:
    name = F.when(F.col(LABEL) == 0, "legitimate").when(F.col(LABEL) == 1, "fraud").otherwise(
        F.col(LABEL).cast("string")
    )
    known = df.where(F.col(LABEL).isNotNull())
    counts = known.groupBy(name.alias("label")).agg(F.count("*").alias("rows"))
    return counts.orderBy(F.desc("rows"), "label")


def negative_amounts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("amount") < 0).alias("negative_amounts"))


def describe(df: DataFrame, columns: tuple[str, ...] = NUMERIC_COLUMNS) -> DataFrame:
    """(column, stat, value): count, mean, std, min, 25%, 50%, 75%, max.

    Moments come from one pass; quantiles are exact and ranked in parallel, because
    Spark's own exact percentile keeps every distinct value in one task.
    """
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    moments = df.agg(
        *[make(c).cast("double").alias(f"{c} {s}") for c in columns for s, make in stats.items()]
    )
    entries = {f"{c} {s}": F.col(f"`{c} {s}`") for c in columns for s in stats}
    tidy = long_form(moments, entries, "entry", "value").select(
        F.substring_index("entry", " ", 1).alias("column"),
        F.substring_index("entry", " ", -1).alias("stat"),
        "value",
    )
    values = df.select(
        F.explode(
            F.array(
                *[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]
            )
        ).alias("r")
    ).select("r.*")
    quartiles = exact_quantiles(values, "value", (0.25, 0.5, 0.75), by=["column"])
    names = {"25%": F.col("q0"), "50%": F.col("q1"), "75%": F.col("q2")}
    tidy_quartiles = quartiles.select(
        "column",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("stat"), v.alias("value")) for k, v in names.items()])
        ).alias("r"),
    ).select("column", "r.*")
    return tidy.unionByName(tidy_quartiles)


def clip_upper(df: DataFrame, column: str = "amount", fraction: float = CLIP_FRACTION) -> DataFrame:
    """Adds `<column>_clipped`: the value, at most the given quantile of the column."""
    limit = exact_quantiles(df, column, (fraction,))
    return (
        df.crossJoin(F.broadcast(limit))  # one row
        .withColumn(f"{column}_clipped", F.when(F.col(column).isNotNull(), F.least(column, "q0")))
        .drop("q0")
    )


def amount_histogram(df: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """(bin, bin_start, rows): equal bins of the amount clipped at its 99% quantile."""
    limits = exact_quantiles(df, "amount", (0.0, CLIP_FRACTION)).select(
        F.when(F.col("q0") < F.col("q1"), F.col("q0")).otherwise(F.col("q0") - 0.5).alias("low"),
        F.when(F.col("q0") < F.col("q1"), F.col("q1")).otherwise(F.col("q1") + 0.5).alias("high"),
        F.col("q1").alias("cap"),
    )
    limits = limits.withColumn("width", (F.col("high") - F.col("low")) / F.lit(float(bins)))
    placed = df.where(F.col("amount").isNotNull()).crossJoin(F.broadcast(limits))  # one row
    clipped = F.least("amount", "cap")
    guess = F.least(F.floor((clipped - F.col("low")) / F.col("width")), F.lit(bins - 1).cast("long"))

    def start(number: Column) -> Column:
        return F.col("low") + number * F.col("width")

    # A division that lands on the wrong side of an edge moves one bin.
    number = (
        F.when((guess > 0) & (clipped < start(guess)), guess - 1)
        .when((guess < bins - 1) & (clipped >= start(guess + 1)), guess + 1)
        .otherwise(guess)
    )
    counts = placed.groupBy(number.alias("bin")).agg(F.count("*").alias("found"))
    every = limits.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin"),
        "low",
        "width",
    )
    return every.join(F.broadcast(counts), "bin", "left").select(  # at most `bins` rows
        "bin",
        start(F.col("bin")).alias("bin_start"),
        F.coalesce("found", F.lit(0).cast("long")).alias("rows"),
    )


def correlation(df: DataFrame, columns: tuple[str, ...] = CORRELATED) -> DataFrame:
    """(column_a, column_b, correlation) for every ordered pair, from one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    row = df.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a} {b}") for a, b in pairs]
    )
    cells = []
    for a, b in pairs:
        for x, y in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(x).alias("column_a"),
                    F.lit(y).alias("column_b"),
                    F.col(f"`{a} {b}`").alias("correlation"),
                )
            )
    return row.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


def report(df: DataFrame) -> DataFrame:
    """Every section as (section, item, stat, value), in report order.

    The scalar measures and the gaps share one pass over the log.
    """
    scalars = {
        "rows": F.count("*"),
        "fraud_count": _positives(),
        "fraud_percentage": F.coalesce(
            F.round(F.try_divide(F.lit(100.0) * _positives(), F.count("*")), 4), F.lit(0.0)
        ),
        "negative_amounts": F.count_if(F.col("amount") < 0),
    }
    gaps = {f"missing {c}": F.count_if(F.col(c).isNull()) for c in df.columns}
    one_pass = df.agg(
        *[c.cast("double").alias(n) for n, c in {**scalars, **gaps}.items()]
    ).withColumn("columns", F.lit(float(len(df.columns))))

    def section(rows: DataFrame, place: int, name: str) -> DataFrame:
        return rows.select(
            F.lit(place).alias("place"),
            F.lit(name).alias("section"),
            "item",
            "stat",
            F.col("value").cast("double").alias("value"),
        )

    def plain(rows: DataFrame, item: str, value: str) -> DataFrame:
        return rows.select(F.col(item).alias("item"), F.lit("count").alias("stat"), F.col(value).alias("value"))

    top = long_form(one_pass, {n: F.col(n) for n in ("rows", "columns", *list(scalars)[1:])}, "item", "value")
    holes = long_form(one_pass, {c: F.col(f"`missing {c}`") for c in df.columns}, "item", "value")
    parts = [
        section(top.withColumn("stat", F.lit("value")), 1, "overview"),
        section(plain(duplicates(df).withColumn("item", F.lit("duplicate_rows")), "item", "duplicate_rows"), 1, "overview"),
        section(holes.where("value > 0").withColumn("stat", F.lit("count")), 2, "missing"),
        section(plain(type_counts(df), "type", "rows"), 3, "types"),
        section(describe(df).withColumnRenamed("column", "item"), 4, "numbers"),
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def render_markdown(table: DataFrame) -> str:
    """The report as text. The table has a few dozen rows at any data size."""
    lines = ["# Data quality report"]
    section = None
    for r in table.orderBy("place", "item", "stat").collect():
        if r.section != section:
            section = r.section
            lines += ["", f"## {section}", "", "| item | stat | value |", "|---|---|---|"]
        lines.append(f"| {r['item']} | {r.stat} | {r.value:,.4f} |" if r.value is not None else f"| {r['item']} | {r.stat} | |")
    return "\n".join(lines) + "\n"
