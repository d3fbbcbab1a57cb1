import datetime as dt
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.errors import DriftError
from ledgerlens.functions import pvalues
from ledgerlens.operators import drift, monitoring

T0 = dt.datetime(2024, 1, 1)
LOG = "event_id long, logged_at timestamp_ntz, outcome string, latency_ms double, prediction long, fraud_probability double"


@pytest.fixture
def outcome_log(spark):
    def row(i, second, outcome="success", latency=7.0, prediction=0, p=0.2):
        served = outcome == "success"
        return (i, T0 + dt.timedelta(seconds=second), outcome, *((latency, prediction, p) if served else (None,) * 3))

    return spark.createDataFrame(
        [
            row(0, 0),
            row(1, 30, latency=30.0, prediction=1, p=0.9),
            row(2, 59, "invalid_request"),
            row(3, 61, latency=80.0, p=0.0),
            row(4, 400, "features_unavailable"),
            row(5, 410, "malformed"),
            row(6, 420, "not_ready"),
            row(7, 4000, latency=20000.0, prediction=1, p=1.0),
        ],
        LOG,
    )


def by_start(df, *columns):
    return {(r.window_start - T0).seconds: tuple(r[c] for c in columns) for r in df.collect()}


def test_request_rate_counts_only_counted_outcomes(outcome_log):
    got = by_start(monitoring.request_rate(outcome_log), "requests_per_second")
    assert got == {0: (3 / 60,), 60: (1 / 60,), 360: (1 / 60,), 3960: (1 / 60,)}


def test_sliding_windows(outcome_log):
    got = by_start(monitoring.request_rate(outcome_log.where("event_id = 3"), slide="30 seconds"), "requests_per_second")
    assert got == {30: (1 / 60,), 60: (1 / 60,)}


def test_error_ratio(outcome_log):
    assert by_start(monitoring.error_ratio(outcome_log), "error_ratio") == {0: (0.25,), 300: (1.0,), 3900: (0.0,)}


def test_latency_quantiles_interpolate_in_the_bucket(outcome_log):
    got = by_start(monitoring.latency_quantiles(outcome_log), "p50", "p95", "p99")
    # 7 ms, 30 ms, 80 ms: half of three is 1.5, in the bucket from 25 to 50 ms.
    assert got[0][0] == pytest.approx(0.025 + 0.025 * 0.5)
    assert got[0][1] == pytest.approx(0.075 + 0.025 * (2.85 - 2))
    assert got[3900] == (10.0, 10.0, 10.0)


def test_fraud_mean_and_classes(outcome_log):
    assert by_start(monitoring.fraud_per_hour(outcome_log), "fraud_predictions") == {0: (1,), 3600: (1,)}
    assert by_start(monitoring.mean_probability(outcome_log), "mean_probability")[0][0] == pytest.approx(1.1 / 3)
    classes = {((r.window_start - T0).seconds, r.prediction): r.predictions for r in monitoring.class_distribution(outcome_log).collect()}
    assert classes == {(0, 0): 2, (0, 1): 1, (3600, 1): 1}


def test_histogram_and_counters(outcome_log):
    bars = {r.le: r.requests for r in monitoring.probability_histogram(outcome_log).collect()}
    assert len(bars) == 12
    assert (bars["0.0"], bars["0.25"], bars["0.9"], bars["1.0"], bars["+Inf"]) == (1, 2, 3, 4, 4)
    counters = {(r.counter, r.label): r.value for r in monitoring.outcome_counters(outcome_log).collect()}
    assert counters == {
        ("requests", "success"): 4,
        ("requests", "invalid_request"): 1,
        ("requests", "features_unavailable"): 1,
        ("errors", "invalid_request"): 1,
        ("errors", "features_unavailable"): 1,
    }


def test_live_performance_leaves_unscored_rows_out(spark, outcome_log):
    truth = spark.range(8).select(F.col("id").alias("event_id"), (F.col("id") % 2).alias("isFraud"))
    got = monitoring.live_performance(outcome_log, truth).first()
    assert (got.scored, got.true_positives, got.false_negatives, got.true_negatives) == (4, 2, 1, 1)
    assert got.accuracy == 0.75


@pytest.mark.parametrize("block", [50, 64, 1 << 20])
def test_rolling_accuracy_equals_pandas(spark, block):
    rng = random.Random(1)
    rows = [("hot", i, None if rng.random() < 0.1 else rng.random() < 0.7) for i in range(1500)]
    rows += [(f"s{i % 40}", i, rng.random() < 0.5) for i in range(400)]
    df = spark.createDataFrame(rows, "session string, seq long, correct boolean")
    got = monitoring.rolling_accuracy(df, by=["session"], block=block).toPandas().sort_values(["session", "seq"])
    want = df.where("correct IS NOT NULL").toPandas().sort_values(["session", "seq"])
    means = want.astype({"correct": float}).groupby("session")["correct"].rolling(50, min_periods=1).mean()
    assert got["rolling_accuracy"].tolist() == pytest.approx(means.tolist())


def test_last_results(spark):
    df = spark.range(700).withColumnRenamed("id", "seq")
    assert [r.seq for r in monitoring.last_results(df, 25).collect()] == list(range(699, 674, -1))
    assert monitoring.last_results(df).count() == 500


# ---- drift


@pytest.fixture(scope="module")
def frames(spark):
    rng = np.random.default_rng(42)

    def frame(n):
        return spark.createDataFrame(
            [
                (float(a), str(t), float(o), float(w))
                for a, t, o, w in zip(
                    rng.normal(100, 20, n),
                    rng.choice(["TRANSFER", "CASH_OUT", "PAYMENT"], n),
                    rng.normal(1000, 200, n),
                    rng.normal(800, 200, n),
                )
            ],
            "amount double, type string, oldbalanceOrg double, newbalanceOrig double",
        ).cache()

    return frame


@pytest.mark.parametrize("rows", [300, 1500])
@pytest.mark.parametrize(("rule", "tests"), [(drift.TESTS, {"ks", "chi2"}), (drift.DISTANCES, {"wasserstein", "js"})])
def test_drift_of_same_and_shifted_data(frames, rows, rule, tests):
    """The rule is the caller's; the number of rows does not change it."""
    reference = frames(rows)
    same = drift.column_drift(reference, reference, rule)
    assert {r.test for r in same.collect()} == tests
    assert drift.summary(same).first() == (0, 4, 0.0)
    shifted = drift.column_drift(reference, reference.withColumn("amount", F.col("amount") * 5), rule)
    assert {r.column for r in shifted.where("drifted").collect()} == {"amount"}
    assert drift.summary(shifted).first() == (1, 4, 0.25)


def test_statistics_equal_brute_force(spark, frames):
    a, b = frames(200), frames(150).withColumn("amount", F.col("amount") + 15)
    x = np.array([r.amount for r in a.collect()])
    y = np.array([r.amount for r in b.collect()])
    grid = np.sort(np.concatenate([x, y]))
    f = np.searchsorted(np.sort(x), grid, "right") / len(x)
    g = np.searchsorted(np.sort(y), grid, "right") / len(y)
    assert drift.ks_distance(a, b, ["amount"]).first().statistic == pytest.approx(np.abs(f - g).max())
    area = (np.abs(f - g)[:-1] * np.diff(grid)).sum()
    assert drift.wasserstein_distance(a, b, ["amount"]).first().statistic == pytest.approx(area / x.std())


def test_category_statistics(spark):
    a = spark.createDataFrame([("x",)] * 60 + [("y",)] * 40, "type string")
    b = spark.createDataFrame([("x",)] * 25 + [("y",)] * 25, "type string")
    got = drift.chi_square(a, b, ["type"]).first()
    assert (got.statistic, got.freedom) == (pytest.approx(25 / 30 + 25 / 20), 1)
    p, q = np.array([0.6, 0.4]), np.array([0.5, 0.5])
    m = (p + q) / 2
    js = math.sqrt((p * np.log(p / m) + q * np.log(q / m)).sum() / 2)
    assert drift.js_distance(a, b, ["type"]).first().statistic == pytest.approx(js)
    new = drift.column_drift(a, b.unionByName(spark.createDataFrame([("z",)], "type string")), drift.TESTS, numbers=())
    assert new.first().statistic == float("inf") and new.first().p_value == 0.0 and new.first().drifted


def test_numbers_named_as_categories(spark):
    a = spark.range(400).select((F.col("id") % 2).cast("double").alias("flag"), (F.col("id") % 4).cast("double").alias("level"))
    b = a.where("flag = 1 OR level = 0")
    small = {r.column: r.test for r in drift.column_drift(a, b, drift.TESTS, (), ["flag", "level"]).collect()}
    assert small == {"flag": "z", "level": "chi2"}
    large = {r.column: r.test for r in drift.column_drift(a, b, drift.DISTANCES, (), ["flag", "level"]).collect()}
    assert large == {"flag": "js", "level": "js"}
    with pytest.raises(DriftError):
        drift.column_drift(a, b, "by size")


def test_constant_column_does_not_drift(spark):
    a = spark.range(50).select(F.lit(3.0).alias("v"))
    for rule in (drift.TESTS, drift.DISTANCES):
        assert not drift.column_drift(a, a, rule, ["v"], ()).first().drifted


def test_gaps_are_left_out(spark):
    a = spark.createDataFrame([(1.0,), (None,), (math.nan,), (2.0,)], "v double")
    assert drift.ks_distance(a, a, ["v"]).first().reference_rows == 2


def test_p_values():
    # Published table values.
    assert pvalues.chi_square(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi_square(9.487729, 4) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi_square(11.070498, 5) == pytest.approx(0.05, abs=1e-6)
    assert pvalues.chi_square(0.0, 3) == pytest.approx(1.0)
    assert pvalues.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_ks_p_value_equals_counting_all_orders():
    from itertools import combinations

    m, n = 4, 5
    distances = []
    for picks in combinations(range(m + n), m):
        x = y = 0
        worst = 0.0
        for i in range(m + n):
            x, y = (x + 1, y) if i in picks else (x, y + 1)
            worst = max(worst, abs(x / m - y / n))
        distances.append(worst)
    for d in sorted(set(distances)):
        want = sum(v >= d - 1e-12 for v in distances) / len(distances)
        assert pvalues.kolmogorov_smirnov(d, m, n, exact=True) == pytest.approx(want)
        assert pvalues.kolmogorov_smirnov(d, n, m, exact=True) == pytest.approx(want)


def test_ks_limit_meets_the_exact_value():
    exact = pvalues.kolmogorov_smirnov(0.05, 1000, 3000, exact=True)
    assert pvalues.kolmogorov_smirnov(0.05, 1000, 3000) == pytest.approx(exact, rel=0.1)


@pytest.mark.parametrize("rule", [drift.TESTS, drift.DISTANCES])
def test_a_stored_profile_gives_the_same_drift(spark, tmp_path, rule):
    draw = random.Random(9)

    def table(n, scale):
        rows = [(draw.choice([None, float("nan"), round(draw.gauss(100, 20) * scale, 1)]), draw.choice(["A", "B", None, "C"]), draw.random(), 1.0) for _ in range(n)]
        return spark.createDataFrame(rows, "amount double, type string, oldbalanceOrg double, newbalanceOrig double")

    reference, current = table(400, 1), table(90, 3)
    path = str(tmp_path / "profile")
    drift.write_profile(reference, path)
    profile = drift.read_profile(spark, path)
    assert profile.agg(F.sum("rows")).first()[0] == drift.reference_profile(reference).agg(F.sum("rows")).first()[0]
    got = {r["column"]: r for r in drift.profile_drift(profile, current, rule).collect()}
    want = {r["column"]: r for r in drift.column_drift(reference, current, rule).collect()}
    assert got.keys() == want.keys() and len(got) == 4
    for c in want:
        for name in ("test", "reference_rows", "current_rows", "distinct_values", "drifted"):
            assert got[c][name] == want[c][name]
        for name in ("statistic", "p_value"):
            assert got[c][name] == (want[c][name] if want[c][name] is None else pytest.approx(want[c][name]))
