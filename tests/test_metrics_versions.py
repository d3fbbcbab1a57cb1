import random
from concurrent.futures import ThreadPoolExecutor

import pytest

from ledgerlens.errors import ModelError
from ledgerlens.operators import metrics, models, versions


def scored(spark, truth, predicted, probability):
    rows = list(zip(truth, predicted, map(float, probability)))
    return spark.createDataFrame(rows, "truth long, prediction long, fraud_probability double")


def test_perfect(spark):
    got = metrics.evaluate(scored(spark, [1, 0, 1, 0, 0, 1, 0], [1, 0, 1, 0, 0, 1, 0], [0.7, 0.05, 0.66, 0.3, 0.41, 0.99, 0.12])).first()
    assert [got[m] for m in (*metrics.SCORES, *metrics.RANKING)] == [1.0] * 6
    assert (got.true_positives, got.true_negatives, got.false_positives, got.false_negatives) == (3, 4, 0, 0)


def test_all_wrong(spark):
    got = metrics.evaluate(scored(spark, [1, 0, 0, 1, 0], [0, 1, 1, 0, 1], [0.22, 0.51, 0.77, 0.08, 0.64])).first()
    assert (got.accuracy, got.precision, got.recall, got.f1, got.roc_auc) == (0.0, 0.0, 0.0, 0.0, 0.0)
    assert (got.false_positives, got.false_negatives) == (3, 2)


def test_never_positive(spark):
    got = metrics.evaluate(scored(spark, [0, 1, 0, 1, 0, 0], [0] * 6, [0.02, 0.4, 0.31, 0.45, 0.11, 0.27])).first()
    assert (got.precision, got.recall, got.f1, got.false_negatives) == (0.0, 0.0, 0.0, 2)
    assert got.roc_auc == 1.0


def test_published_four_row_example(spark):
    got = metrics.ranking(scored(spark, [0, 0, 1, 1], [0, 0, 0, 1], [0.1, 0.4, 0.35, 0.8])).first()
    assert got.roc_auc == pytest.approx(0.75)
    assert got.average_precision == pytest.approx(0.8333333, abs=1e-6)


def test_one_class_only(spark):
    got = metrics.evaluate(scored(spark, [0, 0], [0, 1], [0.1, 0.7])).first()
    assert got.roc_auc is None and got.average_precision == 0.0


def brute(truth, p):
    pos = [x for t, x in zip(truth, p) if t]
    neg = [x for t, x in zip(truth, p) if not t]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted(set(p), reverse=True):
        at = sum(1 for t, x in zip(truth, p) if t and x == s)
        hit, all_ = sum(1 for x in pos if x >= s), sum(1 for x in p if x >= s)
        ap += at / len(pos) * hit / all_
    return auc, ap


def test_ranking_with_ties_and_one_hot_score_per_group(spark):
    rng = random.Random(5)
    rows = {g: [(rng.random() < 0.3, 0.5 if rng.random() < 0.4 else round(rng.random(), 2)) for _ in range(400)] for g in "ab"}
    df = spark.createDataFrame([(g, int(t), p) for g in rows for t, p in rows[g]], "g string, truth long, fraud_probability double")
    for r in metrics.ranking(df, by=["g"]).collect():
        auc, ap = brute([t for t, _ in rows[r.g]], [p for _, p in rows[r.g]])
        assert (r.roc_auc, r.average_precision) == (pytest.approx(auc), pytest.approx(ap))


def test_as_rows(spark):
    got = metrics.as_rows(metrics.evaluate(scored(spark, [0, 1], [0, 1], [0.1, 0.9])), "test_")
    assert {r.metric: r.value for r in got.collect()}["test_true_positives"] == 1.0
    assert got.count() == 10


def runs(spark, *rows):
    table = spark.createDataFrame(list(rows), "model string, spec_order int, split string, average_precision double")
    return table.selectExpr("*", *[f"average_precision AS {m}" for m in metrics.METRICS if m != "average_precision"])


def test_best_run_uses_validation_and_the_first_on_ties(spark):
    table = runs(
        spark,
        ("a", 0, "validation", 0.8),
        ("a", 0, "test", 0.1),
        ("b", 1, "validation", 0.9),
        ("c", 2, "validation", 0.9),
        ("d", 3, "validation", None),
        ("d", 3, "test", 1.0),
    )
    assert metrics.best_run(table).first().model == "b"
    marked = metrics.comparison(table.where("model <> 'd'")).collect()
    assert len(marked) == 15
    assert {r.model for r in marked if r.best} == {"b"}


def version_table(spark):
    rows = [
        ("m", "9", "r9", "Production"),
        ("m", "10", "r10", "Production"),
        ("m", "12", "r12", "None"),
        ("n", "1", "q1", "None"),
    ]
    return spark.createDataFrame(rows, versions.VERSION_SCHEMA)


def test_versions_compare_as_numbers(spark):
    table = version_table(spark)
    assert {r["name"]: r.version for r in versions.latest_versions(table).collect()} == {"m": "12", "n": "1"}
    assert versions.resolve(table, "m") == ("12", "r12")
    assert versions.resolve(table, "m", versions.PRODUCTION) == ("10", "r10")
    assert versions.next_version(table, "m") == "13"
    assert versions.next_version(table, "new") == "1"


def test_the_last_move_of_a_version_counts(spark):
    moves = [("m", "12", "Production", 2), ("m", "10", "Archived", 2), ("m", "12", "Staging", 1), ("x", "1", "Production", 9)]
    now = versions.moved(version_table(spark), spark.createDataFrame(moves, versions.MOVE_SCHEMA))
    stages = {(r["name"], r.version): r.stage for r in now.collect()}
    assert stages == {("m", "9"): "Production", ("m", "10"): "Archived", ("m", "12"): "Production", ("n", "1"): "None"}


def test_registrations_at_once_get_numbers_of_their_own(spark, tmp_path):
    folder = str(tmp_path / "models")
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda k: models.register(spark, folder, "m", f"run{k}"), range(6)))
    assert sorted(map(int, got)) == [1, 2, 3, 4, 5, 6]
    table = {r.version: r.run_id for r in models.read_versions(spark, folder).collect()}
    assert table == {v: f"run{k}" for k, v in enumerate(got)}
    assert models.register(spark, folder, "m", "later") == "7" and models.register(spark, folder, "other", "q") == "1"


def test_promotion_moves_a_version(spark, tmp_path):
    folder = str(tmp_path / "models")
    for run in ("r1", "r2", "r3"):
        models.register(spark, folder, "m", run)
    with pytest.raises(ModelError, match="Production"):
        versions.resolve(models.read_versions(spark, folder), "m", versions.PRODUCTION)
    for version, run in (("2", "r2"), ("3", "r3"), ("1", "r1")):  # the last one is a step back
        models.promote(spark, folder, "m", version)
        assert versions.resolve(models.read_versions(spark, folder), "m", versions.PRODUCTION) == (version, run)
    stages = {r.version: r.stage for r in models.read_versions(spark, folder).collect()}
    assert stages == {"1": "Production", "2": "Archived", "3": "Archived"}
    models.promote(spark, folder, "m", "3", archive=False)
    assert versions.resolve(models.read_versions(spark, folder), "m", versions.PRODUCTION) == ("3", "r3")
    with pytest.raises(ModelError, match="no version"):
        models.promote(spark, folder, "m", "9")


def test_absent_versions_are_refused(spark):
    table = version_table(spark)
    with pytest.raises(ModelError, match="registered"):
        versions.resolve(table, "other")
    with pytest.raises(ModelError, match="Production"):
        versions.resolve(table, "n", versions.PRODUCTION)
