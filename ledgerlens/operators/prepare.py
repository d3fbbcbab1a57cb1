"""Feature steps and the shape a model reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.errors import FeatureError
from ledgerlens.functions.features import (
    FEATURE_EXPRESSIONS,
    entity_id,
    event_timestamp,
    type_indicators,
)
from ledgerlens.schema import ENTITY_KEY, EVENT_TIME, FEATURE_NAMES, IDENTIFIERS, MODEL_INPUTS

# Below so many rows an ordered limit needs no estimate first; the rows are the same.
ESTIMATED_FROM = 1 << 20
FeatureStep = Mapping[str, Callable[[], Column]] | Callable[[DataFrame], DataFrame]
DEFAULT_STEPS: tuple[FeatureStep, ...] = (FEATURE_EXPRESSIONS,)


def add_features(df: DataFrame, steps: Sequence[FeatureStep] = DEFAULT_STEPS) -> DataFrame:
    """Applies the steps in order and keeps every input column.

    A step is a set of named expressions or a DataFrame function. The default set is
    one projection. The result must hold every registered feature.
    """
    for step in steps:
        if isinstance(step, Mapping):
            df = df.withColumns({name: make() for name, make in step.items()})
        else:
            df = df.transform(step)
    absent = [name for name in FEATURE_NAMES if name not in df.columns]
    if absent:
        raise FeatureError(f"feature steps did not produce: {absent}")
    return df


def drop_identifiers(df: DataFrame) -> DataFrame:
    return df.drop(*IDENTIFIERS)


def one_hot_type(df: DataFrame) -> DataFrame:
    """Replaces `type` by its 0/1 columns, appended last."""
    return df.withColumns(type_indicators()).drop("type")


def encode(df: DataFrame) -> DataFrame:
    return one_hot_type(drop_identifiers(df))


def bool_to_int(df: DataFrame) -> DataFrame:
    """Casts boolean columns to 0/1, leaves the rest."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({name: F.col(name).cast("long") for name in flags})


def reindex(
    df: DataFrame, order: Sequence[str] = MODEL_INPUTS, keep: Sequence[str] = ()
) -> DataFrame:
    """The `keep` columns, then exactly the trained columns; an absent one is 0."""
    present = set(df.columns)
    return bool_to_int(
        df.select(
            *keep,
            *[F.col(n) if n in present else F.lit(0).cast("long").alias(n) for n in order],
        )
    )


def feature_view(featured: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Entity key, event time and the nine features, in registry order."""
    return featured.select(
        *keep,
        entity_id().alias(ENTITY_KEY),
        event_timestamp().alias(EVENT_TIME),
        *FEATURE_NAMES,
    )


def head_sample(df: DataFrame, n: int, order: Sequence[str] | None = None) -> DataFrame:
    """The first n rows of the log; tables have no file order, so `order` stands in.

    Without one, rows are ordered by step and entity id, and rows that share both by
    their values, so every run and every branch of a plan takes the same rows.
    """
    keys = [F.col("step"), entity_id(), F.xxhash64(*df.columns)] if order is None else [F.col(c) for c in order]
    return smallest(df, n, keys)


def smallest(df: DataFrame, n: int, keys: Sequence[Column]) -> DataFrame:
    """The first n rows by `keys`, without n rows of every partition meeting in one task.

    The first key is a number. Its value at about the n-th place is estimated with a margin;
    only the rows up to it are ordered, unless they turn out to be fewer than n.
    """
    total = df.count()
    if total > 4 * n + ESTIMATED_FROM:
        share = min(1.0, 2.0 * n / total + 0.01)
        first = df.select(keys[0].alias("k")).agg(F.percentile_approx("k", share, 1000).alias("limit")).first().limit
        near = df.where(keys[0].isNull() | (keys[0] <= F.lit(first)))
        if first is not None and near.count() >= n:
            df = near
    return df.orderBy(*keys).limit(n)
