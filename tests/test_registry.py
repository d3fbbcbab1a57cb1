"""Every registered query against its oracle on the smallest data."""

import pytest

import __spark_entry__ as entry
from compare import mismatch
from helpers import SMALL

# The text operators have tests of their own.
QUERIES, ORACLES = dict(entry._REGISTERED), entry.oracles.statements()
# Each fits the specs that `train_compare` fits here; tests/compare.py runs them all.
SLOW = {"model_gbt_level", "model_gbt_leaf", "evaluate_latest", "job_weekly"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - SLOW))
def test_query_equals_oracle(spark, name):
    assert mismatch(QUERIES[name](spark, SMALL), SMALL, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 3
