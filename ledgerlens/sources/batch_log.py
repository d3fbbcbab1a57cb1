"""A log of committed batches of JSON lines.

    data/<run>/<batch>/<attempt>     rows of one attempt at a batch
    commits/<run>/<batch>.<attempt>  empty: that attempt is the batch
    segments/<id>                    rows of many batches
    folds/<n>                        which batches the segments hold: lines (kind, name)

Nothing is read but what a commit or the last fold names. An attempt is committed after its
rows are complete, unless the batch is already, so a batch that runs twice is read once and
a killed writer leaves rows that nobody reads. Should two attempts commit at the same time,
readers take the one of lesser name; both hold the rows of that batch.

`fold` writes all batches that no segment holds as one more segment, then the list that
names it. Older segments are not written again. Folded batches go with the next fold, so a
stream may write, and readers of the list before may read, meanwhile. One fold runs at a
time; of two, the second is refused.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.errors import PredictionLogError
from ledgerlens.sources import folders

FILE_BYTES = 128 << 20
_FOLD_SCHEMA = "kind string, name string"


def committed(spark: SparkSession, path: str) -> dict[str, str]:
    """The attempt of each committed batch, as `<run>/<batch>`; one listing."""
    found: dict[str, str] = {}
    for name in folders.matches(spark, f"{path}/commits/*/*", 2):
        batch, attempt = name.rsplit(".", 1)
        found.setdefault(batch, attempt)  # names are in order
    return found


def is_log(spark: SparkSession, path: str) -> bool:
    return folders.exists(spark, f"{path}/commits")


def append(rows: DataFrame, path: str, run: str | None = None, batch: int = 0) -> bool:
    """Writes one batch and commits it; False if it was committed before.

    Without a `run` the batch is one of its own.
    """
    spark, run, attempt = rows.sparkSession, run or f"once-{uuid.uuid4().hex}", uuid.uuid4().hex
    if folders.matches(spark, f"{path}/commits/{run}/{batch}.*", 2):
        return False
    folder = f"{path}/data/{run}/{batch}/{attempt}"
    rows.write.json(folder)
    if folders.matches(spark, f"{path}/commits/{run}/{batch}.*", 2):
        folders.delete(spark, folder)
        return False
    return folders.create_once(spark, f"{path}/commits/{run}/{batch}.{attempt}")


def last_fold(spark: SparkSession, path: str) -> tuple[int, list[str], set[str]]:
    """Number, segments and folded batches of the last complete fold."""
    done = [int(n.split("/")[0]) for n in folders.matches(spark, f"{path}/folds/*/_SUCCESS", 2)]
    if not done:
        return 0, [], set()
    rows = spark.read.schema(_FOLD_SCHEMA).json(f"{path}/folds/{max(done)}").collect()
    return max(done), [r.name for r in rows if r.kind == "segment"], {r.name for r in rows if r.kind == "folded"}


def lines(spark: SparkSession, path: str) -> DataFrame:
    """All committed rows as text lines (`value`)."""
    _, segments, folded = last_fold(spark, path)
    fresh = [f"{path}/data/{b}/{a}" for b, a in committed(spark, path).items() if b not in folded]
    read = [f"{path}/segments/{s}" for s in segments] + fresh
    if not read:
        raise PredictionLogError(f"nothing is logged at {path}")
    return spark.read.text(read)


def fold(spark: SparkSession, path: str, shrink: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Folds the batches since the last fold; the number of the fold that is valid then.

    `shrink` may turn their lines into fewer that say the same.
    """
    number, segments, folded = last_fold(spark, path)
    here = committed(spark, path)
    fresh = {b: a for b, a in here.items() if b not in folded}
    if not fresh:
        return number
    read = [f"{path}/data/{b}/{a}" for b, a in fresh.items()]
    files = 1 + sum(folders.size(spark, f) for f in read) // FILE_BYTES
    segment = uuid.uuid4().hex
    lines = spark.read.text(read)
    lines = lines if shrink is None else shrink(lines)
    lines.repartition(files).write.text(f"{path}/segments/{segment}")
    # Of folded batches only those that are still there, so the list does not grow with age.
    names = [("segment", s) for s in (*segments, segment)] + [("folded", b) for b in here]
    listed = spark.createDataFrame(names, _FOLD_SCHEMA).coalesce(1)
    listed.write.mode("error").json(f"{path}/folds/{number + 1}")
    for batch in folded & here.keys():
        run = batch.split("/")[0]
        # Rows first: a batch whose commit is there is in the list above.
        folders.delete(spark, f"{path}/data/{batch}")
        for commit in folders.matches(spark, f"{path}/commits/{batch}.*", 1):
            folders.delete(spark, f"{path}/commits/{run}/{commit}")
    return number + 1
