"""Model version table: (name, version, run_id, stage); versions are numeric text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.errors import ModelError

PRODUCTION, ARCHIVED = "Production", "Archived"
VERSION_SCHEMA = "name string, version string, run_id string, stage string"
MOVE_SCHEMA = "name string, version string, stage string, move long"


def moved(versions: DataFrame, moves: DataFrame) -> DataFrame:
    """The versions with the stage of their last move, where they have one."""
    last = moves.groupBy("name", "version").agg(F.max_by("stage", "move").alias("_stage"))
    joined = versions.join(last, ["name", "version"], "left")
    return joined.select("name", "version", "run_id", F.coalesce("_stage", "stage").alias("stage"))


def latest_versions(versions: DataFrame) -> DataFrame:
    """The numerically highest version of each name."""
    number = F.col("version").try_cast("bigint")
    newest = F.max_by(F.struct("version", "run_id", "stage"), number)
    return versions.where(number.isNotNull()).groupBy("name").agg(newest.alias("r")).select("name", "r.*")


def production_versions(versions: DataFrame, stage: str = PRODUCTION) -> DataFrame:
    """The newest version of each name in the given stage."""
    return latest_versions(versions.where(F.col("stage") == stage))


def next_version(versions: DataFrame, name: str) -> str:
    """Version number for a newly registered run."""
    row = latest_versions(versions.where(F.col("name") == name)).select("version").first()
    return str(int(row.version) + 1) if row else "1"


def resolve(versions: DataFrame, name: str, stage: str | None = None) -> tuple[str, str]:
    """(version, run_id) of the latest or staged version; refuses when there is none."""
    named = versions.where(F.col("name") == name)
    row = (production_versions(named, stage) if stage else latest_versions(named)).first()
    if row is None:
        wanted = f"in stage {stage}" if stage else "registered"
        raise ModelError(f"no version of {name!r} is {wanted}")
    return row.version, row.run_id
