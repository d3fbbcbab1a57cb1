"""Stored features in key buckets, so that a lookup does not move them.

The stored rows are written once, dealt to buckets by the hash that Spark's own shuffle
uses and sorted by key. A batch of requests is then shuffled to the same buckets, and each
task merges them with one bucket file; the stored side has no exchange. Spark cannot split
a hot key of such a join, so keys with more than 1/HOT_SHARE of the requests, of which
there are fewer than HOT_SHARE, are looked up apart: their stored rows are broadcast.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.errors import FeatureError
from ledgerlens.functions.features import entity_id
from ledgerlens.schema import ENTITY_KEY, FEATURE_NAMES
from ledgerlens.sources import folders

BUCKETS = 64
HOT_SHARE = 1024


def write_buckets(stored: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes one row per key; a folder's bucket number is part of its name."""
    name = f"buckets_{uuid.uuid4().hex}"
    rows = stored.select(ENTITY_KEY, *FEATURE_NAMES).repartition(buckets, ENTITY_KEY)
    try:
        writer = rows.write.mode("overwrite").bucketBy(buckets, ENTITY_KEY).sortBy(ENTITY_KEY)
        writer.option("path", f"{path}/of-{buckets}").saveAsTable(name)
    finally:  # the files stay: the table is external
        stored.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows, known to Spark as bucketed."""
    found = [n for n in folders.names(spark, path) if n.startswith("of-")]
    if len(found) != 1:
        raise FeatureError(f"no bucketed features at {path}")
    buckets, name = int(found[0].removeprefix("of-")), f"buckets_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{path}/{found[0]}").schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{ENTITY_KEY}`) SORTED BY (`{ENTITY_KEY}`) INTO {buckets} BUCKETS LOCATION '{path}/{found[0]}'"
    )
    spark.catalog.refreshTable(name)
    return spark.table(name)


def hot_keys(keyed: DataFrame) -> DataFrame:
    """Keys with more than 1/HOT_SHARE of all rows: fewer than HOT_SHARE, whatever the data."""
    counts = keyed.groupBy(ENTITY_KEY).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    return counts.join(F.broadcast(total), F.col("_n") > F.col("_all") / HOT_SHARE).select(ENTITY_KEY)  # one row


def lookup(requests: DataFrame, bucketed: DataFrame, how: str = "left") -> DataFrame:
    """Requests with their stored features, null where none are stored (`left`), or those
    without a stored row (`left_anti`). `bucketed` as `read_buckets` gives it."""
    keyed = requests if ENTITY_KEY in requests.columns else requests.withColumn(ENTITY_KEY, entity_id())
    # Both branches must see the same list, and it is small.
    hot = [r[0] for r in hot_keys(keyed).collect() if r[0] is not None]
    plain = bucketed.hint("merge")
    if not hot:
        return keyed.join(plain, ENTITY_KEY, how)
    is_hot = F.coalesce(F.col(ENTITY_KEY).isin(hot), F.lit(False))
    few = F.broadcast(bucketed.where(F.col(ENTITY_KEY).isin(hot)))  # one row per hot key
    usual = keyed.where(~is_hot).join(plain, ENTITY_KEY, how)
    return usual.unionByName(keyed.where(is_hot).join(few, ENTITY_KEY, how))
