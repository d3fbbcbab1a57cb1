import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens import schema
from ledgerlens.errors import FeatureError
from ledgerlens.functions.features import FEATURE_EXPRESSIONS, double_text, entity_id, event_timestamp, finite
from ledgerlens.operators import prepare
from ledgerlens.schema import FEATURE_NAMES, MODEL_INPUTS


def features_of(df):
    return prepare.add_features(df).first().asDict()


def test_feature_version_is_the_published_one():
    assert schema.feature_version() == "d6bdfb2a6697"


def test_expressions_follow_the_registry():
    assert tuple(FEATURE_EXPRESSIONS) == FEATURE_NAMES


def test_balance_errors_and_deltas(row):
    got = features_of(row(amount=50.0, oldbalanceOrg=200.0, newbalanceOrig=120.0, oldbalanceDest=10.0, newbalanceDest=75.0))
    assert got["orig_balance_error"] == 30.0
    assert got["dest_balance_error"] == -15.0
    assert got["orig_balance_delta"] == -80.0
    assert got["dest_balance_delta"] == 65.0


@pytest.mark.parametrize(
    ("old", "new", "want"), [(100.0, 0.0, 1), (0.0, 0.0, 0), (100.0, 1.0, 0), (None, 0.0, 0), (100.0, None, 0)]
)
def test_depleted(row, old, new, want):
    assert features_of(row(oldbalanceOrg=old, newbalanceOrig=new))["is_orig_balance_depleted"] == want


@pytest.mark.parametrize(
    ("old", "new", "amount", "want"),
    [(0.0, 0.0, 5.0, 1), (0.0, 0.0, 0.0, 0), (1.0, 0.0, 5.0, 0), (0.0, 3.0, 5.0, 0), (0.0, 0.0, None, 0)],
)
def test_untouched(row, old, new, amount, want):
    got = features_of(row(oldbalanceDest=old, newbalanceDest=new, amount=amount))
    assert got["is_dest_balance_untouched"] == want


def test_ratio_with_zero_and_minus_one_balance(row):
    assert features_of(row(amount=50.0, oldbalanceOrg=0.0))["amount_to_orig_balance_ratio"] == 50.0
    assert features_of(row(amount=50.0, oldbalanceOrg=-1.0))["amount_to_orig_balance_ratio"] is None


@pytest.mark.parametrize(("step", "hour"), [(1, 1), (23, 23), (24, 0), (25, 1), (-1, 23)])
def test_hour(row, step, hour):
    assert features_of(row(step=step))["hour_of_day"] == hour


@pytest.mark.parametrize(("name", "want"), [("M1", 1), ("C1", 0), ("m1", 0), (None, 0)])
def test_merchant(row, name, want):
    assert features_of(row(nameDest=name))["is_dest_merchant"] == want


def test_input_columns_are_kept(log):
    out = prepare.add_features(log)
    assert out.columns == [*log.columns, *FEATURE_NAMES]
    assert out.select(*log.columns).exceptAll(log).isEmpty()


def test_custom_steps_and_missing_feature(log):
    doubled = prepare.add_features(log, [*prepare.DEFAULT_STEPS, lambda d: d.withColumn("twice", F.col("amount") * 2)])
    assert doubled.first().twice == 200.0
    with pytest.raises(FeatureError):
        prepare.add_features(log, [{"hour_of_day": FEATURE_EXPRESSIONS["hour_of_day"]}])


def test_double_text_equals_python(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, 181.0, 9839.64, 1e7, 10000000.01, 92445516.64, 356015889.35, 1e-3, 1e-4, 9.9e-5, 1e-5]
    values += [0.00123, 1e15, 123456789012345.6, 1e16, 1.5e16, 1.2345e22, 1e100, -1e7, -2.5, -1e-7, 999999.99, 9999999.99]
    values += [math.inf, -math.inf, math.nan]
    values += [round(rng.uniform(0, 10 ** rng.randint(1, 9)), 2) for _ in range(3000)]
    values += [rng.uniform(0, 1e9) for _ in range(500)]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", double_text(F.col("v")).alias("t"))
    wrong = [(r.v, r.t) for r in rows.collect() if r.t != str(r.v)]
    assert wrong == []


def python_key(r):
    text = f"{r.step}:{r.type}:{r.nameOrig}:{r.nameDest}:{r.amount}:{r.oldbalanceOrg}"
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def test_entity_id_equals_python(log, row):
    for df in (log, row(amount=10000000.0, oldbalanceOrg=92445516.64)):
        for r in df.withColumn("id", entity_id()).collect():
            assert r.id == python_key(r)
            assert len(r.id) == 16


def test_entity_id_is_never_null(row):
    assert row(amount=None, nameDest=None).select(entity_id().alias("id")).first().id


def test_entity_id_ignores_the_other_balances(row):
    def key(**changes):
        return row(**changes).select(entity_id().alias("id")).first().id

    assert key() == key(newbalanceDest=5.0) == key(newbalanceOrig=7.0)
    assert key() != key(amount=100.5)


def test_event_timestamp(row):
    got = [str(row(step=s).select(event_timestamp().alias("t")).first().t) for s in (1, 24, 743)]
    assert got == ["2024-01-01 01:00:00", "2024-01-02 00:00:00", "2024-01-31 23:00:00"]


def test_finite(spark):
    df = spark.createDataFrame([(1.0,), (math.nan,), (math.inf,), (None,)], "v double")
    assert [r.f for r in df.select(finite(F.col("v")).alias("f")).collect()] == [1.0, None, None, None]


def test_encoding_gives_the_model_order(log):
    out = prepare.encode(prepare.add_features(log))
    assert [c for c in out.columns if c != "isFraud"] == list(MODEL_INPUTS)
    first = out.first()
    assert (first.type_PAYMENT, first.type_TRANSFER) == (1, 0)


def test_reindex_fills_absent_and_drops_unknown(log):
    out = prepare.reindex(log.withColumn("extra", F.lit(True)), ["amount", "type_DEBIT", "step"])
    assert out.columns == ["amount", "type_DEBIT", "step"]
    assert out.first() == (100.0, 0, 1)


def test_bool_to_int(log):
    out = prepare.bool_to_int(log.select("step", (F.col("step") > 1).alias("late")))
    assert dict(out.dtypes) == {"step": "bigint", "late": "bigint"}


def test_feature_projection_is_one_native_projection(log):
    """Features add no exchange and no Python worker to the plan."""
    plan = prepare.feature_view(prepare.add_features(log))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Project") == 1
    assert "Python" not in plan
