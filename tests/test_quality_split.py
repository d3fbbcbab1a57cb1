import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.errors import QualityError, SplitError
from ledgerlens.operators import quality, split, validation
from ledgerlens.plans import jobs
from ledgerlens.schema import NUMERIC_COLUMNS, TRANSACTION_SCHEMA


def test_clean_log(log):
    assert quality.overview(log).first() == (60, 11)
    assert quality.missing(log).isEmpty()
    assert quality.duplicates(log).first().duplicate_rows == 0
    assert quality.fraud_balance(log).first() == (15, 25.0)
    assert {r["type"]: r.rows for r in quality.type_counts(log).collect()} == dict.fromkeys(
        ("PAYMENT", "TRANSFER", "CASH_OUT", "CASH_IN", "DEBIT"), 12
    )
    assert {r.label: r.rows for r in quality.label_counts(log).collect()} == {"legitimate": 45, "fraud": 15}


def test_injected_faults(log, row):
    bad = log.unionByName(log.where("step = 5")).unionByName(row(amount=None)).unionByName(row(amount=-1.0))
    assert [tuple(r) for r in quality.missing(bad).collect()] == [("amount", 1)]
    assert quality.duplicates(bad).first().duplicate_rows == 1
    assert quality.negative_amounts(bad).first().negative_amounts == 1


def test_rows_with_gaps_count_as_equal(row):
    twice = row(amount=None).unionByName(row(amount=None))
    assert quality.duplicates(twice).first().duplicate_rows == 1


def test_empty_log(log):
    empty = log.where("step < 0")
    assert quality.fraud_balance(empty).first() == (0, 0.0)
    assert quality.duplicates(empty).first().duplicate_rows == 0
    with pytest.raises(QualityError, match="empty"):
        jobs.assert_trainable(empty)
    with pytest.raises(QualityError, match="positive"):
        jobs.assert_trainable(log.withColumn("isFraud", F.lit(0).cast("long")))
    jobs.assert_trainable(log)


@pytest.fixture
def uneven(spark):
    rng = np.random.default_rng(11)
    n = 777
    data = {c: rng.exponential(1000, n).round(2) for c in NUMERIC_COLUMNS}
    data["amount"][:300] = 42.0  # a hot value
    rows = pd.DataFrame(data).assign(
        step=rng.integers(1, 50, n), type="DEBIT", nameOrig="C1", nameDest="M1", isFraud=rng.integers(0, 2, n), isFlaggedFraud=0
    )[TRANSACTION_SCHEMA.names]
    return rows, spark.createDataFrame(rows, TRANSACTION_SCHEMA)


def test_describe_equals_pandas(uneven):
    rows, df = uneven
    got = {(r["column"], r.stat): r.value for r in quality.describe(df).collect()}
    for c in NUMERIC_COLUMNS:
        for stat, value in rows[c].describe().items():
            assert got.pop((c, stat)) == pytest.approx(value, rel=1e-12)
    assert not got


def test_histogram_equals_numpy(uneven):
    rows, df = uneven
    clipped = rows["amount"].clip(upper=rows["amount"].quantile(0.99))
    counts, edges = np.histogram(clipped, bins=50)
    got = quality.amount_histogram(df).orderBy("bin").toPandas()
    assert got["rows"].tolist() == counts.tolist()
    assert got["bin_start"].tolist() == pytest.approx(edges[:-1].tolist())


def test_histogram_of_a_constant(row):
    got = quality.amount_histogram(row(amount=7.0)).toPandas()
    assert got["rows"].sum() == 1 and len(got) == 50


def test_correlation_equals_pandas(uneven):
    rows, df = uneven
    want = rows[list(quality.CORRELATED)].corr()
    got = quality.correlation(df).collect()
    assert len(got) == 36
    for r in got:
        assert r.correlation == pytest.approx(want.loc[r.column_a, r.column_b], abs=1e-9)


def test_clip(uneven):
    rows, df = uneven
    limit = rows["amount"].quantile(0.99)
    got = quality.clip_upper(df).agg(F.max("amount_clipped").alias("m"), F.count("*").alias("n")).first()
    assert got.m == pytest.approx(limit) and got.n == len(rows)


def test_report_holds_every_section(log, row):
    text = quality.render_markdown(quality.report(log.unionByName(row(amount=None))))
    for words in ("overview", "missing", "types", "numbers", "duplicate_rows", "CASH_OUT", "25%"):
        assert words in text


# ---- temporal split


def test_split_of_sixty_rows(log):
    got = {r.split: tuple(r)[1:4] for r in split.summary(split.temporal_split(log)).collect()}
    assert got == {"train": (42, 1, 42), "validation": (9, 43, 51), "test": (9, 52, 60)}
    jobs.assert_split(split.temporal_split(log))


def test_a_step_is_never_divided(log):
    heavy = log.unionByName(log.withColumn("step", F.lit(30).cast("long")))
    parts = split.temporal_split(heavy).groupBy("step").agg(F.count_distinct("split").alias("n"))
    assert parts.agg(F.max("n")).first()[0] == 1


def test_cutoffs_equal_pandas(uneven):
    rows, df = uneven
    share = rows["step"].value_counts().sort_index().cumsum() / len(rows)
    got = split.cutoffs(df).first()
    assert got.train_end == share.index[(share >= 0.7).argmax()]
    assert got.validation_end == share.index[(share >= 0.7 + 0.15).argmax()]


@pytest.mark.parametrize("sizes", [(0.0, 0.1), (1.0, 0.1), (0.7, 0.0), (0.7, 0.31), (0.7, 0.5)])
def test_bad_sizes(log, sizes):
    with pytest.raises(SplitError):
        split.temporal_split(log, *sizes)


@pytest.mark.parametrize("column", ["step", "isFraud"])
def test_missing_columns(log, column):
    with pytest.raises(SplitError, match=column):
        split.temporal_split(log.drop(column))


def test_one_class_or_empty_part_is_refused(log):
    late_clean = log.withColumn("isFraud", F.when(F.col("step") > 51, 0).otherwise(F.col("isFraud")).cast("long"))
    with pytest.raises(SplitError, match="test"):
        jobs.assert_split(split.temporal_split(late_clean))
    one_step = split.temporal_split(log.withColumn("step", F.lit(1).cast("long")))
    rows = {r.split: (r.rows, r.usable) for r in validation.split_classes(one_step).collect()}
    assert rows["train"] == (60, True) and rows["test"] == (0, False)
