"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerlens")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is set (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)  # tree learners cut their lineage there
        return folder
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlens-"))
    return context.getCheckpointDir()


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a scratch table; a path that is not there is left alone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/ledgerlens-{name}-{uuid.uuid4().hex}"
