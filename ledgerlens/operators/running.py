"""Running totals and exact quantiles over an ordered column, without one big task.

A plain window without PARTITION BY pulls every row into one task. Here the ordered
values are cut into even ranges, each range is summed, and the range sums (4096
rows per group at most) give every range its starting offset. The windows then run inside one
range each. Nothing is approximated: only the places of the cuts are estimated, and
any cut gives the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


_RADIX = 8
# Ranges of an ordered column, and spans per group in the first step of a quantile. Fixed,
# so the sketch that finds the cuts and the rows that carry the offsets stay as small as
# they are on any cluster; a range is sorted by one task, which spills if it is large.
RANGES = _RADIX**4
_SPANS = _RADIX**3


def _place(df: DataFrame, value: str, cuts: str, count: int, name: str) -> DataFrame:
    """Adds `name`: how many of the `count - 1` sorted cuts lie below the value.

    Each step is a projection that narrows the place to an eighth, so the search runs in
    generated code. No step is nullable, which spares joins on the place a null test
    that would repeat the search.
    """
    base, stride = "0", count // _RADIX
    while stride:
        below = [f"`{cuts}`[{base} + {j * stride - 1}] < `{value}`" for j in range(1, _RADIX)]
        passed = " + ".join(f"coalesce(int({test}), 0)" for test in below)
        step = name if stride == 1 else f"{name}_{stride}"
        df = df.withColumn(step, F.expr(f"{base} + {stride} * ({passed})"))
        base, stride = f"`{step}`", stride // _RADIX
    return df.drop(cuts, *[c for c in df.columns if c.startswith(f"{name}_")])


def with_ranges(grouped: DataFrame, value: str, counts: Sequence[str]) -> DataFrame:
    """Adds `_range`: ranges hold about equally many rows and follow the value's order.

    The cuts read the counts too, so Spark sees the same aggregate here as in the
    caller's other branches and reuses its shuffle.
    """
    n = RANGES
    size = sum((F.col(c) for c in counts), F.lit(0))
    points = [i / n for i in range(1, n)]
    cuts = grouped.agg(
        F.percentile_approx(F.when(size >= 0, F.col(value)), points, 4 * n).alias("_cuts")
    )
    # One row of n - 1 numbers, whatever the data size.
    return _place(grouped.crossJoin(F.broadcast(cuts)), value, "_cuts", n, "_range")


def running_totals(
    grouped: DataFrame,
    value: str,
    counts: Sequence[str],
    by: Sequence[str] = (),
    following: bool = False,
) -> DataFrame:
    """Adds `<count>_before` and `<count>_total` per count, in ascending value order.

    `grouped` has one row per (by, value), value not null. The offsets are at most
    `RANGES` rows per group and carry no join hint: their size decides how they are joined.
    `following` also adds `_next`, the next value of the group.
    """
    by = list(by)
    ranged = with_ranges(grouped, value, counts)
    sums = ranged.groupBy(*by, "_range").agg(
        *[F.sum(c).alias(c) for c in counts], F.min(value).alias("_first")
    )
    # At most `RANGES` rows per group reach this window.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_offset_{c}") for c in counts],
        *[F.sum(c).over(group).alias(f"{c}_total") for c in counts],
        F.lead("_first").over(group.orderBy("_range")).alias("_next_range"),
    )
    # Null-safe, so that a group without a name keeps its rows.
    offsets = offsets.withColumnsRenamed({c: f"_of_{c}" for c in [*by, "_range"]})
    same = F.col("_range") == F.col("_of__range")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    joined = ranged.join(offsets, same).drop(*[f"_of_{c}" for c in [*by, "_range"]])

    inside = Window.partitionBy(*by, "_range").orderBy(value)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    added = {
        f"{c}_before": F.col(f"_offset_{c}") + F.coalesce(F.sum(c).over(before), F.lit(0))
        for c in counts
    }
    if following:
        added["_next"] = F.coalesce(F.lead(value).over(inside), F.col("_next_range"))
    return joined.withColumns(added).drop(
        "_range", "_next_range", *[f"_offset_{c}" for c in counts]
    )


def exact_quantiles(
    df: DataFrame, value: str, fractions: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Linear-interpolation quantiles as columns q0, q1, ... with one row per group.

    `by` must take a fixed handful of values. Nulls are left out. The rows are counted
    per span between estimated cuts; the exact counts tell which spans hold the wanted
    ranks, and only the values of those few spans are shuffled and ranked.
    """
    by = list(by)
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    points = [i / _SPANS for i in range(1, _SPANS)]
    # One row per group, of a fixed size.
    cuts = F.broadcast(rows.groupBy(*by).agg(F.percentile_approx("_v", points, 4 * _SPANS).alias("_cuts")))
    paired = rows.join(cuts, by) if by else rows.crossJoin(cuts)
    placed = _place(paired, "_v", "_cuts", _SPANS, "_span")

    # At most `_SPANS` rows per group from here to `wanted`.
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    earlier = group.orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        placed.groupBy(*by, "_span")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_all", F.sum("_rows").over(group))
    )
    places = [F.lit(float(f)) * (F.col("_all") - 1) for f in fractions]

    def holds(rank: Column, first: Column, rows_here: Column) -> Column:
        return (first <= rank) & (rank < first + rows_here)

    hit = F.lit(False)
    for place in places:
        for rank in (F.floor(place), F.ceil(place)):
            hit = hit | holds(rank, F.col("_first"), F.col("_rows"))
    wanted = F.broadcast(spans.where(hit).select(*by, "_span", "_first", "_all"))

    near = placed.join(wanted, [*by, "_span"]).groupBy(*by, "_span", "_first", "_all", "_v")
    ranked = running_totals(near.agg(F.count("*").alias("_n")), "_v", ["_n"], [*by, "_span"])
    start = F.col("_first") + F.col("_n_before")

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(rank, start, F.col("_n")), F.col("_v")))

    picks = []
    for i, place in enumerate(places):
        picks += [
            at(F.floor(place)).alias(f"_low{i}"),
            at(F.ceil(place)).alias(f"_high{i}"),
            F.max(place - F.floor(place)).alias(f"_part{i}"),
        ]
    picked = ranked.groupBy(*by).agg(*picks)

    def between(i: int) -> Column:
        low, high, part = (F.col(f"_{name}{i}") for name in ("low", "high", "part"))
        return (low + (high - low) * part).alias(f"q{i}")

    return picked.select(*by, *[between(i) for i in range(len(fractions))])


def row_numbers(df: DataFrame, order: str, by: Sequence[str] = ()) -> DataFrame:
    """Adds `_row` (0, 1, ...) per group in order; `order` is unique within a group.

    Works for one huge group and for many groups alike.
    """
    counted = df.withColumn("_one", F.lit(1).cast("long"))
    return (
        running_totals(counted, order, ["_one"], by)
        .withColumnRenamed("_one_before", "_row")
        .drop("_one", "_one_total")
    )
