"""Exact n-gram Jaccard join by partitions of the token universe.

Two sets with similarity of at least t differ in at most H = (1 - t) / (1 + t) * (a + b)
tokens. Sets are put in size bands, and for each band the universe of tokens is dealt by
hash to segments. A segment matched whole is worth one unit, a segment matched up to one
deleted token is worth two; with H + 1 units allocated, one segment at least must match
(pigeonhole). `allocate` picks per band, by cost, how many segments of either kind there
are, and how many spare units: with e spare units a set leaves out its first e empty whole
segments, which would match half the corpus. Both sides leave out in the same order, so a
match that counts stays (an empty segment agreed on beyond the e-th is kept by both).

A pair is looked for in the segments of the larger set's band; a set whose partners may
fall in the next band is indexed there too. Keys with several sets give candidates, linked
as stars around the smallest set first, then exactly: every pair under a shared key whose
sets are not yet in one component is verified. No candidate is dropped or capped.

Before the exact check a pair is held against parity sketches: bit i tells whether an odd
number of a set's tokens hash to i, so two sketches never differ in more bits than the sets
in tokens, and a pair that differs in more than it may is no link. The pairs under a key
are compared by their sketches inside a task; keys with many sets are cut into blocks, and
each pair of blocks is a group of its own. The sets of a key's largest component are not
compared with each other. Of the pairs that may be links a group puts out those that
connect its components, nearest first; if it has others, its key goes to another round,
with the components found by then. Keys of one component are done. When a round finds no
link, the keys that are left put out all their pairs.

Which keys several sets have is counted on keys of six bytes alone, in buckets that a task
sorts; only sets that several rows have come with their node there, since copies of one set
are no pair. A second pass lists the sets of these keys. Where the sets themselves are
needed, their texts move, compressed, and the sets are made again.

A row of this check carries its set's sketch, once per key that it shares. The keys are taken
in parts, one after the other, so that the rows of a part take about half the bytes of the sets
have at eight bytes a token; a part begins with the components that those before it have found.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import common
from ledgerlens.llm.common import K1, mix, ngram_hashes, places, split_words, stored, text_bytes
from ledgerlens.llm.graph import components

BLOCK = 4096
#: Groups of so few sets are compared many at a time, by lists of so many pairs.
SMALL_GROUP, PAIRS_AT_ONCE = 64, 1 << 20
ROWS_AT_ONCE, BYTES_AT_ONCE = 1 << 16, 4 << 20
BROADCAST_NODES = 500_000
#: A key is so many bytes; a task sorts so many at once, and a bucket of them has about so many.
KEY_BYTES, KEYS_AT_ONCE, KEYS_A_BUCKET = 6, 1 << 20, 1 << 17
#: Rows of a part of the keys take at least so many bytes, and so many more beside the sketch.
PART_BYTES, ROW_BYTES = 128 << 20, 64
SET_LOW, SET_HIGH = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


# ---- sets


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct n-gram hashes; fewer words count as one sequence."""
    yield from _sets(*text_bytes(texts), n)


def _sets(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[np.ndarray]:
    for low, high in common.pieces(offsets):
        words = split_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lower=True)
        one = words.hashes()
        grams = ngram_hashes(one, n)
        for begin, end, first, last in zip(*places(words.first, n), words.first[:-1], words.first[1:], strict=True):
            if end > begin:
                yield np.unique(grams[begin:end])
            elif last > first:
                yield ngram_hashes(one[first:last], last - first) ^ np.uint64(last - first)
            else:
                yield np.zeros(0, np.uint64)


def unpacked_sets(packed: list[bytes], n: int) -> Iterator[np.ndarray]:
    """The sets of compressed texts; about `common.PIECE_BYTES` of them are unpacked at once."""
    unpack = zstandard.ZstdDecompressor()
    offsets = np.cumsum([0, *map(zstandard.frame_content_size, packed)])
    for low, high in common.pieces(offsets):
        data = np.frombuffer(b"".join(map(unpack.decompress, packed[low:high])), np.uint8)
        yield from _sets(data, offsets[low : high + 1] - offsets[low], n)


def hashed(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each token: one deals it out, the other is summed."""
    return mix(sets ^ SET_LOW), mix(sets ^ SET_HIGH)


def set_key(value: np.ndarray) -> int:
    """64 bits that stand for a set, from the summed hashes of its tokens."""
    return int(mix(mix(value).sum(keepdims=True) ^ np.uint64(len(value))).view(np.int64)[0])


def sketch(dealt: np.ndarray) -> bytes:
    """Parities of the tokens per slot, in two or more bits per token."""
    bits = max(9, (2 * len(dealt) - 1).bit_length())
    return np.packbits(np.bincount((dealt >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits) & 1 > 0).tobytes()


#: Two neighbouring bits become their parity: a byte gives four bits.
HALF = np.array([sum((b >> 2 * k & 1 ^ b >> 2 * k + 1 & 1) << k for k in range(4)) for b in range(256)], np.uint8)


class Sketches:
    """Sketches of many sets in one buffer, read by row at any size they can be folded to."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_binary())
        self.offset = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
        self.data = np.frombuffer(column.buffers()[2], np.uint8)
        self.size = np.diff(self.offset)
        self.levels: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _level(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Each row's place, and all rows of that size or more, folded to it."""
        if length not in self.levels:
            place, same = np.full(len(self.size), -1, np.int64), np.flatnonzero(self.size == length)
            parts = [np.zeros((0, length), np.uint8)]
            for some in np.array_split(same, len(same) * length // (1 << 20) + 1):
                parts.append(self.data[self.offset[some][:, None] + np.arange(length)])
            place[same] = np.arange(len(same))
            longer = np.flatnonzero(self.size > length)
            if len(longer):
                above, rows = self._level(2 * length)
                rows = HALF[rows[above[longer]]]
                parts.append(rows[:, ::2] << 4 | rows[:, 1::2])
                place[longer] = len(same) + np.arange(len(longer))
            self.levels[length] = place, np.concatenate(parts)
        return self.levels[length]

    def rows(self, at: np.ndarray, length: int) -> np.ndarray:
        """Rows of words, folded to so many bytes."""
        place, rows = self._level(length)
        return rows[place[at]].view(np.uint64)


def sketch_distance(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the finer one folded to the other's size."""
    short, long = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
    if len(short) < len(long):
        bits = np.unpackbits(long).reshape(len(short) * 8, -1)
        long = np.packbits(bits.sum(1) & 1 > 0)
    return int(np.bitwise_count(short ^ long).sum())


@common.frugal
def _sizes(batches, n: int):
    for batch in batches:
        size, node = [], []
        for s in shingle_sets(batch.column(1), n):
            size.append(len(s))
            node.append(set_key(hashed(s)[1]) if len(s) else None)
        numbers = [pa.array(x, pa.int64()) for x in (size, node)]
        yield pa.record_batch([batch.column(0), *numbers], ["doc_id", "n_shingles", "node"])


# ---- bands and segments


def bands(largest: int, num: int, den: int) -> list[tuple[int, int]]:
    """Half-open size ranges; partners are in the same or in a neighbouring range."""
    out, low = [], 1
    while low <= largest:
        high = max(low + 1, -(-low * den // num), -(-low * 3 // 2))
        out.append((low, high))
        low = high
    return out


def allocate(low: int, high: int, count: int, num: int, den: int) -> tuple[int, int, int]:
    """(deletion segments, whole segments, spare units) of least estimated cost.

    Cost: keys written, plus pairs expected to meet only under empty segments.
    """
    need = (den - num) * 2 * (high - 1) // (den + num) + 1
    size, best = (low + high - 1) / 2, None
    for spare in sorted({*range(9), *range(9, need // 2 + 9, max(1, need // 64))}):
        units = need + spare
        for deletions in sorted({*range(min(8, units // 2) + 1), units // 2}):
            whole = units - 2 * deletions
            segments = whole + deletions
            empty = math.exp(-low / segments)
            mean = whole * empty
            left = sum(
                (k - spare) * math.exp(k * math.log(mean) - mean - math.lgamma(k + 1)) for k in range(spare + 1, spare + 30)
            ) if mean else 0.0
            pairs = (count * left) ** 2 / max(1, 2 * whole) + deletions * (count * empty) ** 2 / 2
            cost = count * (whole + deletions * (1 + size / segments)) + pairs
            if best is None or cost < best[0]:
                best = cost, (deletions, whole, spare)
    return best[1]


def segment_keys(dealt: np.ndarray, value: np.ndarray, band: int, plan: tuple[int, int, int]) -> np.ndarray:
    """Keys of a set in the segments of a band: whole ones and one-deletion neighbours."""
    deletions, whole, spare = plan
    segments = deletions + whole
    at = ((dealt >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    total = np.zeros(segments, np.uint64)
    np.add.at(total, at, value)
    kept = np.arange(segments)
    if spare and len(empty := np.flatnonzero(np.bincount(at, minlength=segments)[deletions:] == 0)):
        kept = np.delete(kept, empty[:spare] + deletions)
    salt = mix(np.arange(segments, dtype=np.uint64) + np.uint64(band << 32) + K1)
    keys = mix(total[kept] ^ salt[kept])
    if not deletions:
        return keys
    inside = at < deletions
    return np.concatenate([keys, mix((total[at[inside]] - value[inside]) ^ salt[at[inside]])])


def index_keys(dealt: np.ndarray, value: np.ndarray, edges: list[tuple[int, int]], plans: list, num: int, den: int):
    size = len(value)
    band = bisect.bisect_right(edges, (size, math.inf)) - 1
    own = segment_keys(dealt, value, band, plans[band])
    if band + 1 < len(edges) and size * den >= num * edges[band + 1][0]:
        return np.concatenate([own, segment_keys(dealt, value, band + 1, plans[band + 1])])
    return own


def short(keys: np.ndarray) -> np.ndarray:
    """Keys of `KEY_BYTES` bytes. Sets that meet under one by chance are told apart later."""
    return keys >> np.uint64(64 - 8 * KEY_BYTES)


def bucket_count(edges, plans, counts: dict[int, int]) -> int:
    """Buckets for the keys of all sets, from an upper estimate of their number."""
    total = 0.0
    for k, ((low, high), (deletions, whole, _)) in enumerate(zip(edges, plans, strict=True)):
        each = whole + deletions * (1 + (low + high) / 2 / max(1, deletions + whole))
        total += (counts.get(k, 0) + counts.get(k - 1, 0)) * each
    return max(1, int(total) // KEYS_A_BUCKET)


@common.frugal
def _bundles(batches, n: int, edges, plans, num: int, den: int, copied, buckets: int):
    """(bucket, alone, key, node): keys of a bucket as bytes, once per set of a task.

    `alone` has those of sets that one row has; keys of sets that `copied` admits, which
    other tasks may have too, come with their node. Of a key two sets are enough.
    """
    seen: set[int] = set()
    keys, nodes, held = [], [], 0
    for batch in batches:
        for s in shingle_sets(batch.column(0), n):
            dealt, value = hashed(s)
            if not len(s) or (node := set_key(value)) in seen:
                continue
            seen.add(node)
            keys.append(short(index_keys(dealt, value, edges, plans, num, den)))
            nodes.append(node)
            held += len(keys[-1])
            if held >= KEYS_AT_ONCE:
                yield _bundle(keys, nodes, copied.value, buckets)
                keys, nodes, held = [], [], 0
    if keys:
        yield _bundle(keys, nodes, copied.value, buckets)


def _bundle(keys: list[np.ndarray], nodes: list[int], copied: np.ndarray, buckets: int) -> pa.RecordBatch:
    node, size = np.array(nodes, np.int64), np.array([len(k) for k in keys])
    key, marked = np.concatenate(keys), np.repeat(common.admitted(node, copied), size)
    alone = _two_of_each(np.sort(key[~marked]))[0]
    node, key = np.repeat(node, size)[marked], key[marked]
    order = np.argsort(key, kind="stable")
    key, node = _two_of_each(key[order], node[order])
    columns = [(_cut(k, buckets), k, v) for k, v in ((alone, _as_bytes(alone)), (key, _as_bytes(key)), (key, node.view(np.uint8).reshape(-1, 8)))]
    some = np.flatnonzero(np.any([np.diff(at) for at, _, _ in columns], axis=0))
    made = []
    for at, k, v in columns:
        ends = np.append(at[some], len(k)).astype(np.int32) * v.shape[1]
        made.append(pa.Array.from_buffers(pa.binary(), len(some), [None, pa.py_buffer(ends), pa.py_buffer(v.tobytes())]))
    return pa.record_batch([pa.array(some, pa.int64()), *made], ["bucket", "alone", "key", "node"])


def _two_of_each(key: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted keys, each at most twice, and what belongs to them."""
    kept = np.ones(len(key), bool)
    kept[2:] = key[2:] != key[:-2]
    return tuple(x[kept] for x in (key, *others))


def _cut(key: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of sorted keys begins, and their end."""
    bucket = (key >> np.uint64(8 * KEY_BYTES - 32)) * np.uint64(buckets) >> np.uint64(32)
    return np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))


def _as_bytes(key: np.ndarray) -> np.ndarray:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]


def _from_bytes(packed: list[bytes]) -> np.ndarray:
    some = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, KEY_BYTES)
    out = np.zeros((len(some), 8), np.uint8)
    out[:, :KEY_BYTES] = some
    return out.view("<u8").ravel()


@common.frugal
def _shared(batches):
    """Rows of `_bundles` sorted by bucket: the keys that several sets have, once."""
    last, held = None, ([], [], [])
    for batch in batches:
        for bucket, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != last and held[0]:
                yield _of_several(*held)
                held = [], [], []
            last = bucket
            for some, part in zip(held, parts, strict=True):
                some.append(part)
    if held[0]:
        yield _of_several(*held)


def _of_several(alone: list[bytes], keys: list[bytes], nodes: list[bytes]) -> pa.RecordBatch:
    key, node = _from_bytes(keys), np.frombuffer(b"".join(nodes), np.int64)
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    one = np.ones(len(key), bool)
    one[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    every = np.sort(np.concatenate([_from_bytes(alone), key[one]]))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    return pa.record_batch([pa.array(again.view(np.int64))], ["key"])


@common.frugal
def _keys(batches, n: int, edges, plans, num: int, den: int, wanted):
    """(key, node) of the keys that `wanted` admits, once per set of a task."""
    seen: set[int] = set()
    for batch in batches:
        keys, nodes, held = [], [], 0
        for s in shingle_sets(batch.column(0), n):
            dealt, value = hashed(s)
            if not len(s) or (node := set_key(value)) in seen:
                continue
            seen.add(node)
            mine = short(index_keys(dealt, value, edges, plans, num, den))
            mine = mine[common.admitted(mine, wanted.value)]
            keys.append(mine.view(np.int64))
            nodes.append(np.full(len(mine), node, np.int64))
            held += len(mine)
            if held >= ROWS_AT_ONCE:
                yield from _sliced(keys, nodes)
                keys, nodes, held = [], [], 0
        yield from _sliced(keys, nodes)


def _sliced(keys: list[np.ndarray], nodes: list[np.ndarray]):
    """Batches of few rows: buffers on both sides of the worker stay small."""
    if keys:
        key, node = np.concatenate(keys), np.concatenate(nodes)
        for low in range(0, len(key), ROWS_AT_ONCE):
            part = slice(low, low + ROWS_AT_ONCE)
            yield pa.record_batch([pa.array(key[part]), pa.array(node[part])], ["key", "node"])


@common.frugal
def _blobs(batches, n: int, wanted):
    """(node, size, sketch, compressed text) of the sets that the filter admits, once per task."""
    pack = zstandard.ZstdCompressor()
    seen: set[int] = set()

    def made(rows):
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["node", "n", "sketch", "packed"])

    for batch in batches:
        rows: list[tuple[int, int, bytes, bytes]] = []
        held = 0
        data, offsets = text_bytes(batch.column(0))
        for i, s in enumerate(_sets(data, offsets, n)):
            dealt, value = hashed(s)
            if not len(s) or (node := set_key(value)) in seen:
                continue
            seen.add(node)
            if common.admitted(np.array([node]), wanted.value)[0]:
                rows.append((node, len(s), sketch(dealt), pack.compress(data[offsets[i] : offsets[i + 1]].tobytes())))
                held += s.nbytes
                if held >= BYTES_AT_ONCE:
                    yield made(rows)
                    rows, held = [], 0
        yield made(rows)


# ---- verification


@common.frugal
def _linked(batches, n: int, num: int, den: int):
    for frame in batches:
        keep = np.zeros(len(frame), bool)
        sets = unpacked_sets([p for pair in zip(frame["x"], frame["y"], strict=True) for p in pair], n)
        for i, (x, y) in enumerate(zip(sets, sets, strict=True)):
            both = len(x) + len(y) - len(np.union1d(x, y))
            keep[i] = den * both >= num * (len(x) + len(y) - both)
        yield frame.loc[keep, ["a", "b"]]


@common.frugal
def _alike(batches, num: int, den: int):
    for frame in batches:
        keep = np.zeros(len(frame), bool)
        for i, (m, n, x, y) in enumerate(zip(frame["m"], frame["n"], frame["x"], frame["y"], strict=True)):
            keep[i] = (
                min(m, n) * den >= num * max(m, n) and sketch_distance(x, y) * (den + num) <= (den - num) * (m + n)
            )
        yield frame.loc[keep, ["a", "b"]]


def _with_both(pairs: DataFrame, items: DataFrame, x: str) -> DataFrame:
    """Pairs (a, b) with what the two nodes have: columns m, x of a and n, y of b."""
    left = items.select(F.col("node").alias("a"), F.col("n").alias("m"), F.col(x).alias("x"))
    right = items.select(F.col("node").alias("b"), "n", F.col(x).alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y")


def verified(pairs: DataFrame, sets: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs that are links: by sketches first, then by the sets of those that remain."""
    near = _with_both(pairs, sets, "sketch").mapInPandas(lambda b: _alike(b, num, den), "a long, b long")
    near = stored(near, "near")
    ends = _ends(near)
    if ends.count() <= BROADCAST_NODES:
        ends = F.broadcast(ends)
    own = sets.join(ends, "node", "left_semi")
    return _with_both(near, own, "packed").mapInPandas(lambda b: _linked(b, n, num, den), "a long, b long")


GROUP = ("key", "low", "high", "block")


@common.frugal
def _possible(batches, num: int, den: int, nearest: bool):
    """Rows sorted by `GROUP`: pairs of different roots under a key that may be links.

    A group is two blocks of at most about `BLOCK` sets, or one with itself; it is held
    until it is whole. With `nearest` a group gives only pairs that connect components,
    nearest first, and its key if there are others.
    """
    held = None
    for batch in batches:
        batch = batch if held is None else pa.concat_batches([held, batch])
        group = [batch.column(k).to_numpy() for k in range(3)]
        last = np.flatnonzero(np.any([g != g[-1:] for g in group], axis=0))
        cut = last[-1] + 1 if len(last) else 0
        held = batch.slice(cut)
        if cut:
            yield _pairs(batch.slice(0, cut), num, den, nearest)
    if held is not None and held.num_rows:
        yield _pairs(held, num, den, nearest)


def _pairs(batch: pa.RecordBatch, num: int, den: int, nearest: bool) -> pa.RecordBatch:
    """Pairs (a, b) of whole groups that may be links, and the keys that have more."""
    key, low, high, block, node, root, size = (batch.column(k).to_numpy() for k in range(7))
    sketches = Sketches(batch.column(7))
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
    begin = np.append(np.flatnonzero(new), len(key))
    own = np.cumsum(new) - 1
    lefts = np.bincount(own, block == low)
    right = np.where(low[begin[:-1]] == high[begin[:-1]], -1, begin[:-1] + lefts.astype(np.int64))
    found = [(np.zeros(0, np.int64),) * 3]
    small = np.diff(begin)[own] <= SMALL_GROUP
    at = np.flatnonzero(small)
    first = np.where(right[own[at]] < 0, at + 1, np.where(block[at] == low[at], right[own[at]], begin[own[at] + 1]))
    count = begin[own[at] + 1] - first
    for part in np.array_split(np.arange(len(at)), int(count.sum()) // PAIRS_AT_ONCE + 1):
        i, j = np.repeat(at[part], count[part]), common.ranges(first[part], count[part])
        keep = _may_differ(i, j, root, size, num, den)
        found.append(_near_pairs(i[keep], j[keep], node, size, sketches, num, den))
    for g in np.flatnonzero(np.diff(begin) > SMALL_GROUP):
        rows = np.arange(begin[g], begin[g + 1])
        left, partners = (rows, rows) if right[g] < 0 else (rows[rows < right[g]], rows[rows >= right[g]])
        found.append(_near_blocks(left, partners, own, root, size, sketches, num, den, nearest))
    i, j, distance = (np.concatenate(x) for x in zip(*found, strict=True))
    kept = _spanning(own[i], root[i], root[j], distance) if nearest else np.ones(len(i), bool)
    more = np.unique(key[begin[np.unique(own[i[~kept]])]])
    a, b = (f(node[i[kept]], node[j[kept]]) for f in (np.minimum, np.maximum))
    columns = [pa.array(x, pa.int64()) for x in (a, b)], pa.nulls(len(more), pa.int64())
    return pa.record_batch(
        [pa.concat_arrays([c, columns[1]]) for c in columns[0]] + [pa.concat_arrays([pa.nulls(len(a), pa.int64()), pa.array(more, pa.int64())])],
        ["a", "b", "more"],
    )


def _may_differ(i, j, root, size, num: int, den: int) -> np.ndarray:
    return (root[i] != root[j]) & (np.minimum(size[i], size[j]) * den >= num * np.maximum(size[i], size[j]))


def _near_pairs(i, j, node, size, sketches: Sketches, num: int, den: int):
    """(a, b) of listed pairs whose sketches are close enough; each pair once."""
    a, b = np.minimum(node[i], node[j]), np.maximum(node[i], node[j])
    order = np.lexsort((b, a))
    one = np.ones(len(order), bool)
    one[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    i, j = i[order[one]], j[order[one]]
    length = np.minimum(sketches.size[i], sketches.size[j])
    distance = np.zeros(len(i), np.int64)
    for bytes_ in np.unique(length):
        for same in np.array_split(np.flatnonzero(length == bytes_), int((length == bytes_).sum() * bytes_) // (1 << 22) + 1):
            differ = sketches.rows(i[same], int(bytes_)) ^ sketches.rows(j[same], int(bytes_))
            distance[same] = np.bitwise_count(differ).sum(1, dtype=np.int64)
    near = distance * (den + num) <= (den - num) * (size[i] + size[j])
    return i[near], j[near], distance[near]


def _spanning(group, x, y, distance) -> np.ndarray:
    """Of pairs between components x and y of a group, nearest first, those that connect
    what no pair before them has connected in the group."""
    kept, above = np.zeros(len(group), bool), {}

    def top(c):
        while (up := above.get(c, c)) != c:
            above[c] = above.get(up, up)
            c = up
        return c

    order = np.argsort(distance, kind="stable")
    for at, g, p, q in zip(order.tolist(), group[order].tolist(), x[order].tolist(), y[order].tolist()):
        p, q = top((g, p)), top((g, q))
        if p != q:
            above[p] = q
            kept[at] = True
    return kept


def _near_blocks(rows, partners, own, root, size, sketches: Sketches, num: int, den: int, nearest: bool):
    """Places (i, j) and distances of the near pairs of two blocks, a strip of rows at a
    time; with `nearest` of every strip those that connect, and one more if any is left out."""
    length = int(min(sketches.size[rows].min(), sketches.size[partners].min()))
    left, right = sketches.rows(rows, length), sketches.rows(partners, length)
    found = [(np.zeros(0, np.int64),) * 3]
    for part in np.array_split(np.arange(len(rows)), len(rows) // 128 + 1):
        distance = np.zeros((len(part), len(partners)), np.int32)
        for word in range(left.shape[1]):
            distance += np.bitwise_count(left[part, word][:, None] ^ right[:, word][None])
        both = size[rows[part]][:, None] + size[partners][None]
        near = (distance * (den + num) <= (den - num) * both) & (root[rows[part]][:, None] != root[partners][None])
        if rows is partners:
            near &= part[:, None] < np.arange(len(partners))[None]
        i, j = np.nonzero(near)
        i, j, distance = rows[part[i]], partners[j], distance[i, j].astype(np.int64)
        if nearest and len(i):
            kept = _spanning(own[i], root[i], root[j], distance)
            if not kept.all():  # it stays behind again, and so names its key
                kept[np.argmin(kept)] = True
            i, j, distance = i[kept], j[kept], distance[kept]
        found.append((i, j, distance))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _mixed(placed: DataFrame) -> DataFrame:
    """Per key of several components: the largest one, how many blocks it and the others
    have, and how many rows the blocks' groups take."""
    by_root = placed.groupBy("key", "root").count().groupBy("key")
    mixed = by_root.agg(F.max(F.struct("count", "root")).alias("big"), F.sum("count").alias("many"), F.count("*").alias("roots"))
    apart = F.when(F.col("big.count") > 1, F.col("big.count")).otherwise(0)
    mixed = mixed.filter("roots > 1").select(
        "key",
        F.when(apart > 0, F.col("big.root")).alias("big"),
        F.ceil((F.col("many") - apart) / BLOCK).cast("int").alias("others"),
        F.ceil(apart / BLOCK).cast("int").alias("bigs"),
        apart.alias("apart"),
        (F.col("many") - apart).alias("rest"),
    )
    rows = F.col("rest") * (F.col("others") + F.col("bigs")) + F.col("apart") * F.col("others")
    return mixed.withColumn("rows", rows).drop("apart", "rest")


def _parts(placed: DataFrame, sets: DataFrame) -> int:
    """In how many parts the keys are taken."""
    rows = _mixed(placed).agg(F.sum("rows")).first()[0] or 0
    held, row = sets.agg(F.sum("n") * 8, F.avg(F.length("sketch"))).first()
    return max(1, math.ceil(rows * ((row or 0) + ROW_BYTES) / max((held or 0) / 2, PART_BYTES)))


def possible_links(placed: DataFrame, sets: DataFrame, num: int, den: int, nearest: bool = False) -> DataFrame:
    """Pairs (a, b) under a shared key that are in different components and may be links.

    `placed`: key, node, root. Keys of one component need no pairs and are left out. Of the
    others the largest component is kept apart, in blocks of its own that meet only blocks
    of the other sets. Rows with `more` name the keys of which only nearest pairs are here.
    """
    rows = placed.join(_mixed(placed).drop("rows"), "key").join(sets.select("node", "n", "sketch"), "node")
    is_big, dealt = F.coalesce(F.col("root") == F.col("big"), F.lit(False)), F.xxhash64("node")
    rows = rows.withColumn(
        "block",
        F.when(is_big, F.col("others") + F.pmod(dealt, F.col("bigs"))).otherwise(F.pmod(dealt, F.col("others"))).cast("int"),
    )
    meets = F.col("others") - 1 + F.when(is_big, 0).otherwise(F.col("bigs"))
    other = F.explode(F.sequence(F.lit(0), meets)).alias("other")
    rows = rows.select("key", "node", "root", "n", "sketch", "block", other).select(
        "key", "node", "root", "n", "sketch", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    dealt = rows.repartition("key", "low", "high").sortWithinPartitions(*GROUP)
    columns = dealt.select(*GROUP, "node", "root", "n", "sketch")
    return columns.mapInArrow(lambda b: _possible(b, num, den, nearest), "a long, b long, more long").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def with_nodes(docs: DataFrame, n: int = 4) -> DataFrame:
    """All rows and columns of `docs`, with `node`: the key of the text's set, null without shingles."""
    others = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c not in ("text", "node"))).alias("rest")
    base = docs.select(others, "text")

    @common.frugal
    def keyed(batches):
        for batch in batches:
            nodes = [set_key(hashed(s)[1]) if len(s) else None for s in shingle_sets(batch.column(1), n)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(nodes, pa.int64())], ["rest", "text", "node"])

    out = base.mapInArrow(keyed, T.StructType([*base.schema.fields, T.StructField("node", T.LongType())]))
    return out.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c != "node"), "node")


def jaccard_components(docs: DataFrame, n: int = 4, num: int = 85, den: int = 100, keyed: bool = False) -> DataFrame:
    """Documents with the classes of the links J >= num / den between their n-gram sets.

    Takes columns doc_id and text, others are ignored. Returns doc_id, n_shingles,
    component_id. Null or empty texts have no shingles, no links and their own id; a null
    doc_id gives a null component unless it is linked to a row that has one; repeated
    rows and repeated ids are rows like others. Copies are one node however many they are.
    With `keyed` there is a fourth column, the row's `node` as `with_nodes` has it.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    texts = base.select("text")
    sizes = stored(
        base.mapInArrow(lambda b: _sizes(b, n), "doc_id long, n_shingles long, node long"), "sizes"
    )
    nodes = stored(
        sizes.filter("node is not null")
        .groupBy("node")
        .agg(F.min("doc_id").alias("first_id"), F.max("n_shingles").alias("n"), F.count("*").alias("copies")),
        "nodes",
    )
    top = nodes.agg(F.max("n")).first()[0] or 0
    edges = bands(top + 1, num, den)
    limits = [high for _, high in edges]
    counts = dict(
        nodes.groupBy(F.expr("size(filter(array(%s), h -> h <= n))" % ",".join(map(str, limits))).alias("band"))
        .count()
        .collect()
    ) if top else {}
    plans = [allocate(*e, counts.get(k, 0) + counts.get(k - 1, 0), num, den) for k, e in enumerate(edges)]

    copied = spark.sparkContext.broadcast(common.key_filter(nodes.filter("copies > 1"), "node"))
    buckets = bucket_count(edges, plans, counts)
    bundles = texts.mapInArrow(
        lambda b: _bundles(b, n, edges, plans, num, den, copied, buckets), "bucket long, alone binary, key binary, node binary"
    )
    shared = stored(bundles.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_shared, "key long"), "shared-keys")
    common.let_go(spark)
    wanted = spark.sparkContext.broadcast(common.key_filter(shared, "key"))
    again = texts.mapInArrow(lambda b: _keys(b, n, edges, plans, num, den, wanted), "key long, node long")
    keyed_nodes = stored(shared.join(again, "key").distinct(), "keyed-nodes")
    least = keyed_nodes.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("members"))
    stars = stored(keyed_nodes.join(least, "key").filter("a < node").select("a", F.col("node").alias("b")).distinct(), "stars")
    members = stored(keyed_nodes.join(least.filter("members > 2"), "key").select("key", "node"), "members")
    common.drop(shared, keyed_nodes)
    ends = _ends(stars)
    listed = spark.sparkContext.broadcast(common.key_filter(ends, "node"))
    sets = (
        texts.mapInArrow(lambda b: _blobs(b, n, listed), "node long, n long, sketch binary, packed binary")
        .join(ends, "node", "left_semi")
        .dropDuplicates(["node"])
    )
    sets = stored(sets, "sets")
    common.let_go(spark)
    links, done = stored(verified(stars, sets, n, num, den), "links"), stars
    common.let_go(spark)
    roots = components(links)
    parts, part = _parts(_placed(members, roots), sets), 0
    left, nearest = _part(members, 0, parts), True
    while True:
        common.let_go(spark)
        round_ = stored(possible_links(_placed(left, roots), sets, num, den, nearest), "possible")
        new = stored(round_.filter("more is null").select("a", "b").join(done, ["a", "b"], "left_anti"), "new-pairs")
        found = stored(verified(new, sets, n, num, den), "found")
        done, some = done.unionByName(new), not found.isEmpty()
        if some:
            common.let_go(spark)
            roots = components(found, roots)
        open_keys = round_.filter("more is not null").select(F.col("more").alias("key"))
        if not open_keys.isEmpty():
            left = stored(left.join(open_keys, "key", "left_semi"), "open-members")
            nearest = some
            continue
        part += 1
        if part == parts:
            break
        left, nearest = _part(members, part, parts), True
    common.drop(sets, members, stars)
    return _labelled(sizes, nodes, roots, ("node",) if keyed else ())


def _placed(members: DataFrame, roots: DataFrame) -> DataFrame:
    return members.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))


def _part(members: DataFrame, part: int, parts: int) -> DataFrame:
    return members.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == part) if parts > 1 else members


def _labelled(sizes: DataFrame, nodes: DataFrame, roots: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    named = nodes.join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "first_id"
    )
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = named.join(least, "root").select("node", "component_id")
    return sizes.join(label, "node", "left").select(
        "doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *more
    )


def brute_force(docs: pd.DataFrame, n: int = 4, num: int = 85, den: int = 100) -> dict[int, int]:
    """doc_id to component by all pairs, for tests."""
    rows = []
    for d, t in zip(docs["doc_id"], docs["text"], strict=True):
        w = (t or "").encode().lower().split()
        rows.append((d, {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()))
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (d, s) in enumerate(rows):
        for e, t in rows[:i]:
            if s and t and den * len(s & t) >= num * len(s | t):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {d: find(d) for d, _ in rows}
