import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.errors import FeatureError
from ledgerlens.operators import buckets, scoring, store
from ledgerlens.schema import ENTITY_KEY


@pytest.fixture
def bucketed(spark, log, tmp_path):
    path = str(tmp_path / "stored")
    buckets.write_buckets(store.build_offline(log.where("step <= 40")), path, 16)
    return buckets.read_buckets(spark, path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_equals_the_plain_join(spark, log, bucketed):
    many = log.unionByName(log.where("step = 3").crossJoin(spark.range(500)).drop("id"))
    many = many.unionByName(log.where("step = 50").crossJoin(spark.range(200)).drop("id"))
    stored = store.build_offline(log.where("step <= 40"))
    for how, want in (("left", scoring.lookup(many, stored)), ("left_anti", scoring.missing_features(many, stored))):
        got = buckets.lookup(many, bucketed, how)
        assert sorted(got.columns) == sorted(want.columns) and got.count() == want.count()
        assert got.select(*want.columns).exceptAll(want).isEmpty()
    assert buckets.lookup(log.limit(0), bucketed).count() == 0


def test_the_stored_side_is_not_shuffled(spark, log, bucketed):
    requests = spark.range(5000).select(F.concat(F.lit("k"), F.col("id") % 2500).alias(ENTITY_KEY), "id")
    found = buckets.lookup(requests, bucketed)
    plan = plan_of(found)
    assert "SortMergeJoin" in plan and len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert "SelectedBucketsCount: 16 out of 16" in plan
    assert found.count() == 5000


def test_a_hot_key_leaves_its_bucket(spark, log, bucketed):
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 9000))
    requests = spark.range(20_000, numPartitions=8).select(key.alias(ENTITY_KEY), "id")
    assert [r[0] for r in buckets.hot_keys(requests).collect()] == ["hot"]
    found = buckets.lookup(requests, bucketed).withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in found.groupBy("task").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 4000


def test_absent_buckets_are_refused(spark, tmp_path):
    with pytest.raises(FeatureError):
        buckets.read_buckets(spark, str(tmp_path / "none"))
