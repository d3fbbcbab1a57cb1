"""Connected components by alternating large-star and small-star steps.

Every step is two shuffles of the edges, and at most about log(n)^2 steps are needed
whatever the shape; each result is written to the shared folder, which cuts the lineage.
The steps end when every component is a star, the smallest node in its centre.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored


#: A task of a step takes about so many links; few links need few tasks.
LINKS_A_TASK = 1 << 16


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b")
    return moved.coalesce(tasks).distinct().coalesce(tasks)


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return moved.coalesce(tasks).unionByName(least.select(F.col("m").alias("a"), "b").coalesce(tasks)).distinct().coalesce(tasks)


def _are_stars(edges: DataFrame, tasks: int) -> bool:
    """Whether every node is either a centre or below one centre alone."""
    ends = edges.select(F.col("a").alias("node"), F.lit(0).alias("below")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(1).alias("below"))
    )
    seen = ends.groupBy("node").agg(F.sum("below").alias("below"), F.count("*").alias("n")).coalesce(tasks)
    return seen.filter("below > 1 or below = 1 and n > 1").count() == 0


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Links (a, b) of longs to (node, root): root is the smallest node that is reachable.

    Nodes without a link to another node are absent. With `known`, an earlier result, its
    components are joined by the links: the steps take the links between them alone.
    """
    ends = links.select("a", "b")
    for x in ("a", "b") if known is not None else ():
        roots = known.select(F.col("node").alias(x), "root")
        ends = ends.join(roots, x, "left").withColumn(x, F.coalesce("root", x)).select("a", "b")
    edges = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges = stored(edges, "links")
    n = edges.count()
    tasks = max(edges.sparkSession.sparkContext.defaultParallelism, n // LINKS_A_TASK)
    while n and not _are_stars(edges, tasks):
        edges = stored(_small_star(stored(_large_star(edges, tasks), "large"), tasks), "small")
    roots = edges.select(F.col("a").alias("node")).distinct().withColumn("root", F.col("node"))
    found = edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
    if known is None:
        return stored(found.coalesce(tasks), "known")
    if not n:
        return known
    above = found.select(F.col("node").alias("root"), F.col("root").alias("above"))
    moved = known.join(above, "root", "left").select("node", F.coalesce("above", "root").alias("root"))
    return stored(moved.unionByName(found.join(known, "node", "left_anti")), "known")
