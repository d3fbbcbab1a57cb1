import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.running import RANGES, _place, exact_quantiles, row_numbers, running_totals


def brute(rows):
    """rows: {(group, value): n} to {(group, value): (before, total, next)}."""
    out = {}
    for g in {g for g, _ in rows}:
        values = sorted(v for h, v in rows if h == g)
        total, before = sum(rows[g, v] for v in values), 0
        for i, v in enumerate(values):
            out[g, v] = (before, total, values[i + 1] if i + 1 < len(values) else None)
            before += rows[g, v]
    return out  # a group may be nameless


@pytest.mark.parametrize("shape", ["uniform", "skewed", "tiny", "equal"])
def test_running_totals_equal_brute_force(spark, shape):
    rng = random.Random(shape)
    rows = {}
    for _ in range({"tiny": 3, "equal": 50}.get(shape, 800)):
        g = "a" if shape == "skewed" and rng.random() < 0.9 else rng.choice(["a", "b", None])
        v = {"skewed": rng.expovariate(9), "equal": 1.5}.get(shape, rng.uniform(-5, 5))
        rows[g, v] = rng.randint(0, 1000 if shape == "skewed" else 3)
    df = spark.createDataFrame([(g, v, n) for (g, v), n in rows.items()], "g string, v double, n long")
    got = running_totals(df, "v", ["n"], ["g"], following=True).collect()
    assert {(r.g, r.v): (r.n_before, r.n_total, r._next) for r in got} == brute(rows)


def test_cuts_do_not_follow_the_shuffle_partitions(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), F.lit(1).cast("long").alias("n"))
    spark.conf.set("spark.sql.shuffle.partitions", "20000")
    try:
        plan = running_totals(df, "v", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert f", {4 * RANGES}," in plan and RANGES == 4096


@pytest.mark.parametrize("partitions", [4, 32, 256])
def test_place_counts_the_cuts_below(spark, partitions):
    rng = random.Random(partitions)
    n = partitions * 2
    cuts = sorted(rng.randint(0, 50) / 2 for _ in range(n - 1))
    rows = [(float(v),) for v in range(-1, 28)] + [(None,)]
    df = spark.createDataFrame(rows, "v double").withColumn("c", F.lit(cuts))
    for r in _place(df, "v", "c", n, "at").collect():
        assert r["at"] == (0 if r.v is None else sum(c < r.v for c in cuts))


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.exponential(100, 501).round(1), "b": rng.normal(0, 1, 40), "c": np.array([4.0])}
    df = spark.createDataFrame([(g, float(v)) for g, vs in values.items() for v in vs], "g string, v double")
    fractions = (0.0, 0.25, 0.5, 0.75, 0.99, 1.0)
    for r in exact_quantiles(df, "v", fractions, by=["g"]).collect():
        assert [r[f"q{i}"] for i in range(6)] == pytest.approx(list(np.quantile(values[r.g], fractions)), abs=1e-9)


def test_quantiles_leave_nulls_out(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantiles(df, "v", (0.5,)).first().q0 == 2.0


def test_row_numbers_of_one_hot_group_and_many_small_ones(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("s"), (F.col("id") * 7 % 3001).alias("seq"))
    small = spark.range(600).select((F.col("id") % 200).cast("string").alias("s"), F.col("id").alias("seq"))
    got = row_numbers(hot.unionByName(small), "seq", ["s"]).toPandas()
    got["want"] = got.groupby("s")["seq"].rank(method="first").astype(int) - 1
    assert (got["_row"] == got["want"]).all()
    assert len(got) == 3600


def test_no_window_over_the_whole_table(spark):
    """Every window is inside a group or works on the range sums."""
    df = spark.range(100).select(F.col("id").cast("double").alias("v"), F.lit(1).cast("long").alias("n"))
    plan = running_totals(df, "v", ["n"])._jdf.queryExecution().sparkPlan().toString()
    assert "Window" in plan
    assert "SinglePartition" not in plan
