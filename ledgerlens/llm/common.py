"""Shared pieces of the text operators: batches, words, hashes, filters.

Words are maximal runs of bytes other than space and 0x09-0x0D. All hashes have 64 bits
and are the same in every process, so they can be shuffled, stored and compared.
"""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import time
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20
PIECE_BYTES = 2 << 20
#: What Spark's cleaner gets to delete the files that were let go.
CLEANER_SECONDS = 1
#: Whether Spark deletes a query's shuffle files when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
SPACES = b" \t\n\x0b\x0c\r"

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
K1, K2, K3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A table of the data folder; batches sent to Python are bounded by bytes, too."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage: writes to the shared folder and reads that.

    The shuffle files of the write go when it ends; nothing else reads them.
    """
    from ledgerlens.session import scratch_path

    conf, path = df.sparkSession.conf, scratch_path(df.sparkSession, name)
    before = conf.get(FILE_CLEANUP, None)
    conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(FILE_CLEANUP) if before is None else conf.set(FILE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes tables of `stored` whose last reader has run."""
    from ledgerlens.session import drop_path

    for table in tables:
        for path in {unquote(f).rsplit("/", 1)[0] for f in table.inputFiles()}:
            drop_path(table.sparkSession, path)


def let_go(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of queries that nothing refers to any more.

    Its cleaner follows the driver's garbage collection, which small plans rarely cause.
    It works beside the driver and gets a second before the next job fills the disk. The
    driver's own free memory goes back to the system, too.
    """
    gc.collect()
    spark._jvm.System.gc()
    give_back()
    time.sleep(CLEANER_SECONDS)


def give_back() -> None:
    """Gives this process's free memory back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def frugal(task):
    """A task's generator that gives free memory back to the system when it ends.

    Spark uses a Python worker for many tasks; what one of them has freed would otherwise
    stay with the worker, beside the needs of the others on the executor.
    """

    @functools.wraps(task)
    def run(*args):
        try:
            yield from task(*args)
        finally:
            give_back()

    return run


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * K2
    x = (x ^ (x >> np.uint64(27))) * K3
    return x ^ (x >> np.uint64(31))


def text_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array (null: empty) and the n + 1 offsets."""
    column = text_array(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `limit` bytes; a longer text is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)


@dataclass
class Words:
    """Words of consecutive texts: `first[d]:first[d + 1]` are those of text d."""

    data: np.ndarray
    start: np.ndarray
    length: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return hash_slices(self.data, self.start, self.length)

    def text(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.length[i]].tobytes()


def split_words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> Words:
    data = LOWER[data] if lower else data
    inside = np.empty(len(data) + 1, bool)
    inside[:-1] = ~IS_SPACE[data]
    inside[-1] = False
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2]
    ends = inside[:-1] & ~inside[1:]
    edges = offsets[:-1][np.diff(offsets) > 0]
    begins[edges] = inside[edges]
    ends[edges[1:] - 1] |= inside[edges[1:] - 1]
    start = np.flatnonzero(begins)
    return Words(data, start, np.flatnonzero(ends) + 1 - start, np.searchsorted(start, offsets))


def hash_slices(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hashes of byte slices: eight bytes at a time up to 64, xxhash beyond."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, strides=(1,))
    h = mix(length.astype(np.uint64) * K1)
    h = mix((h ^ (eights[start] & KEEP[np.minimum(length, 8)])) * K1)
    for j in range(8, 64, 8):
        rest = np.flatnonzero(length > j)
        if not len(rest):
            return h
        part = eights[start[rest] + j] & KEEP[np.minimum(length[rest] - j, 8)]
        h[rest] = mix((h[rest] ^ part) * K1)
    for i in np.flatnonzero(length > 64):
        h[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + length[i]].tobytes())
    return h


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each place on, over text borders too (see `places`)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    h = words[: len(words) - n + 1] + K2
    for k in range(1, n):
        h = h * K1 + words[k : len(words) - n + 1 + k]
    return mix(h)


def places(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text, where its n-grams begin and end in the array of `ngram_hashes`."""
    return first[:-1], np.maximum(first[:-1], first[1:] - n + 1)


def ranges(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... count[0] of them, then those of the next."""
    total = np.concatenate([[0], np.cumsum(count)]).astype(np.int64)
    return np.repeat(begin - total[:-1], count) + np.arange(total[-1])


class IdCache:
    """Ids of the words that a process has met, by hash; emptied when it is full."""

    def __init__(self, most: int = 1 << 19):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def look_up(self, hashes: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in order, and how many each has.

        `encode` gives the ids of new words, by their places: all ids, and counts.
        """
        keys, one, word = np.unique(hashes, return_index=True, return_inverse=True)
        new = self._unknown(keys)
        if len(self.keys) + len(new) > self.most:
            self.clear()
            new = np.arange(len(keys))
        if len(new):
            self._add(keys[new], *encode(one[new]))
        at = np.searchsorted(self.keys, keys)[word]
        count = self.count[at].astype(np.int64)
        return self.ids[ranges(self.begin[at], count)], count

    def _unknown(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        inside = at < len(self.keys)
        known = np.zeros(len(keys), bool)
        known[inside] = self.keys[at[inside]] == keys[inside]
        return np.flatnonzero(~known)

    def _add(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        """Ids stay in the order in which they came; only the keys are sorted."""
        begin = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, begin])[order]
        self.count = np.concatenate([self.count, size.astype(np.int32)])[order]


def held_out(doc_id: pa.Array, modulus: int) -> np.ndarray:
    """crc32 of the id as text, modulo: 2 is held out; a missing id counts as empty text."""
    return np.array([zlib.crc32(b"" if d is None else str(d).encode()) % modulus == 2 for d in doc_id.to_pylist()], bool)


def sample_by_hash(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The `rows` rows of smallest key hash: a bounded sample that depends on the key alone.

    The hashes are even, so only those below a bound that leaves about twice as many rows
    are ordered, unless fewer than wanted are below it.
    """
    total = df.count()
    bound = min((1 << 63) - 1, -(1 << 63) + (2 * rows + 1000) * (1 << 64) // max(total, 1))
    near = df.filter(F.xxhash64(key) <= F.lit(bound))
    if near.count() < min(rows, total):
        near = df
    return near.orderBy(F.xxhash64(key), key).limit(rows)


# ---- fixed-size filters: they admit every key they were made of, and some others


@frugal
def _packed(batches):
    """One row a batch: its columns of longs as bytes."""
    for batch in batches:
        columns = [pa.array([c.to_numpy(zero_copy_only=False).tobytes()], pa.binary()) for c in batch.columns]
        yield pa.record_batch(columns, batch.schema.names)


def key_filter(df: DataFrame, column: str, bits: int = 25) -> np.ndarray:
    """2^bits bits marking the keys of a long column; made by a bounded aggregate.

    At most 2^(bits - 6) pairs of two numbers reach the driver, whatever the input is; they
    come as bytes, thousands to a row, for a row object each would take many times as much.
    """
    slot = F.xxhash64(F.col(column))
    marked = (
        df.select(
            F.shiftrightunsigned(slot, 64 - bits + 6).alias("w"),
            F.shiftrightunsigned(slot, 64 - bits).bitwiseAND(F.lit(63)).cast("int").alias("b"),
        )
        .groupBy("w")
        .agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m"))
        .coalesce(max(16, df.sparkSession.sparkContext.defaultParallelism))
        .mapInArrow(_packed, "w binary, m binary")
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    for w, m in marked.collect():
        out[np.frombuffer(w, np.int64)] = np.frombuffer(m, np.uint64)
    return out


def spark_hash(values: np.ndarray) -> np.ndarray:
    """Spark's xxhash64 of long values (seed 42)."""
    p1, p2, p3, p4, p5 = (
        np.uint64(x)
        for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
    )
    turn = lambda x, r: (x << np.uint64(r)) | (x >> np.uint64(64 - r))
    with np.errstate(over="ignore"):
        h = np.uint64(42) + p5 + np.uint64(8)
        h = h ^ (turn(values.astype(np.uint64) * p2, 31) * p1)
        h = turn(h, 27) * p1 + p4
        h = (h ^ (h >> np.uint64(33))) * p2
        h = (h ^ (h >> np.uint64(29))) * p3
    return h ^ (h >> np.uint64(32))


def admitted(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    slot = spark_hash(values.view(np.uint64)) >> np.uint64(64 - int(np.log2(len(table))) - 6)
    return (table[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
