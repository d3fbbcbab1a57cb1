"""Fingerprints of improbable features, in chained Bloom filters.

A feature is a window of 64 bytes. Its entropy falls into one of 256 classes; one pass over
all documents counts the windows of each class, and the fewer there are, the rarer the
feature. A feature is selected if it is the rarest within 32 places on either side (equal
ranks: the smaller hash), so selection follows the content and survives edits elsewhere.
Windows of little entropy (runs, padding) come last in rank. Selected features go, in text
order and once each, into Bloom filters of 2048 bits with five hashes and 160 features; a
full filter is followed by the next. Likeness of two fingerprints: each filter of the one
with fewer features takes its best normalised bit overlap in the other, weighted by its
features. A text below 64 bytes is one feature; an empty one has none.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.common import K1, mix

WINDOW, REACH, CLASSES = 64, 32, 256
BITS, HASHES, FULL = 2048, 5, 160
WEAK = 1.5  # bits of entropy below which a window tells little
STREAM_BYTES, MOST_PARTS = 16 << 20, 4096

SCALE = 1 << 12
LOGS = np.array([0] + [round(n * math.log2(n) * SCALE) for n in range(1, WINDOW + 1)], np.int32)
BYTE_HASH = mix(np.arange(256, dtype=np.uint64) + K1)


def entropy_classes(x: np.ndarray) -> np.ndarray:
    """Class of each whole window of the bytes: its entropy, 0 to 6 bits, in 256 steps."""
    n = len(x) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint8)
    ahead, behind = np.ones(len(x), np.uint8), np.zeros(len(x), np.uint8)
    for s in range(1, WINDOW):
        same = (x[s:] == x[:-s]).view(np.uint8)
        ahead[:-s] += same
        behind[s:] += same
    total = np.empty(n, np.int32)
    total[0] = LOGS[np.bincount(x[:WINDOW], minlength=256)].sum()
    if n > 1:
        gone, come = ahead[: n - 1], behind[WINDOW:]
        step = np.diff(LOGS)
        total[1:] = step[come] - step[gone - 1]
    total = np.cumsum(total)
    top = WINDOW * 6 * SCALE
    return (CLASSES - 1 - total * np.int64(CLASSES - 1) // top).astype(np.uint8)


def window_hashes(x: np.ndarray) -> np.ndarray:
    h, factor = BYTE_HASH[x], K1
    with np.errstate(over="ignore"):
        for s in (1, 2, 4, 8, 16, 32):
            h = h[:-s] * factor + h[s:]
            factor = factor * factor
    return mix(h)


def window_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Windows of each entropy class in the texts of a batch."""
    out = np.zeros(CLASSES, np.int64)
    for low, high in common.pieces(offsets, 1 << 18):
        part = data[offsets[low] : offsets[high]]
        inside = _inside(offsets[low : high + 1] - offsets[low], len(part))
        out += np.bincount(entropy_classes(part)[inside], minlength=CLASSES)
    return out


def _inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Which of the windows of joined texts lie in one text."""
    ok = np.zeros(max(0, size - WINDOW + 1) + 1, np.int32)
    begin, end = offsets[:-1], np.maximum(offsets[:-1], offsets[1:] - WINDOW + 1)
    some = end > begin
    np.add.at(ok, begin[some], 1)
    np.add.at(ok, end[some], -1)
    return np.cumsum(ok[:-1]) > 0


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of each class, rarest first, weak classes last; fixed for all documents of a run."""
    weak = np.arange(CLASSES) < WEAK / 6 * CLASSES
    rank = np.zeros(CLASSES, np.uint64)
    rank[np.lexsort((np.arange(CLASSES), counts, weak))] = np.arange(CLASSES)
    return rank


def _least(key: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        key = np.minimum(key[:-step], key[step:])
        reach += step
    return key


class Digest:
    """Feature counts and bits of the filters of one text."""

    def __init__(self, counts: np.ndarray, filters: np.ndarray):
        self.counts, self.filters = counts, filters

    def __str__(self) -> str:
        return f"{self.counts.sum()}:" + base64.b64encode(self.filters.tobytes()).decode()

    def likeness(self, other: Digest) -> float:
        """0 to 1; 1 for equal fingerprints, also for two that are empty."""
        if self.counts.sum() > other.counts.sum():
            return other.likeness(self)
        if not len(self.counts):
            return float(not len(other.counts))
        a, b = self.filters, other.filters
        ones_a, ones_b = (np.bitwise_count(x).sum(1, dtype=np.int64) for x in (a, b))
        best = np.zeros(len(a))
        for i in range(len(a)):
            both = np.bitwise_count(a[i] & b).sum(1, dtype=np.int64)
            chance, most = ones_a[i] * ones_b / BITS, np.minimum(ones_a[i], ones_b)
            best[i] = np.max(np.clip((both - chance) / np.maximum(most - chance, 1e-9), 0, 1))
        return float((best * self.counts).sum() / self.counts.sum())


class Digester:
    def __init__(self, rank: np.ndarray):
        self.rank = rank

    def digests(self, texts: list[bytes]) -> list[Digest]:
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        out: list[Digest] = []
        for low, high in common.pieces(offsets, 1 << 18):
            out += self._some(texts[low:high], offsets[low : high + 1] - offsets[low])
        return out

    def _some(self, texts: list[bytes], offsets: np.ndarray) -> list[Digest]:
        x = np.frombuffer(b"".join(texts), np.uint8)
        text, feature = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        if len(x) >= WINDOW:
            feature = window_hashes(x)
            key = self.rank[entropy_classes(x)] << np.uint64(56) | feature >> np.uint64(8)
            key[~_inside(offsets, len(x))] = np.uint64((1 << 64) - 1)
            edge = np.full(REACH, (1 << 64) - 1, np.uint64)
            least = _least(np.concatenate([edge, key, edge]), 2 * REACH + 1)
            at = np.flatnonzero((key == least) & (key != edge[0]))
            text, feature = np.searchsorted(offsets, at, "right") - 1, feature[at]
        short = [d for d, t in enumerate(texts) if 0 < len(t) < WINDOW]
        if short:
            whole = [int.from_bytes(hashlib.blake2b(texts[d], digest_size=8).digest(), "little") for d in short]
            text, feature = np.append(text, short), np.append(feature, np.array(whole, np.uint64))
        order = np.lexsort((feature, text))
        first = np.ones(len(order), bool)
        first[1:] = (feature[order][1:] != feature[order][:-1]) | (text[order][1:] != text[order][:-1])
        kept = np.sort(order[first])
        kept = kept[np.argsort(text[kept], kind="stable")]
        text, feature = text[kept], feature[kept]
        begin = np.searchsorted(text, np.arange(len(texts) + 1))
        many = -(-np.diff(begin) // FULL)
        base = np.concatenate([[0], np.cumsum(many)])
        place = np.arange(len(text)) - begin[text]
        filter_of = base[text] + place // FULL
        bits = np.zeros(base[-1] * BITS, bool)
        for k in range(HASHES):
            bits[filter_of * BITS + ((feature >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = True
        filters = np.packbits(bits).reshape(-1, BITS // 8)
        counts = np.bincount(filter_of, minlength=base[-1])
        return [Digest(counts[a:b], filters[a:b]) for a, b in zip(base, base[1:], strict=False)]


def rarity(docs: DataFrame) -> np.ndarray:
    """Ranks of the entropy classes over all texts: at most 256 sums reach the driver."""

    def count(batches):
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            total += window_counts(*common.text_bytes(batch.column(0)))
        yield pa.record_batch([pa.array(np.arange(CLASSES)), pa.array(total)], ["class", "n"])

    counts = np.zeros(CLASSES, np.int64)
    for k, n in docs.select("text").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n")).collect():
        counts[k] = n
    return ranks(counts)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every row; null texts count as empty. Other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs))

    def digest(batches):
        digester = Digester(shared.value)
        for batch in batches:
            texts = [t.encode() for t in common.text_array(batch.column(1)).to_pylist()]
            yield pa.record_batch(
                [batch.column(0), pa.array([str(d) for d in digester.digests(texts)], pa.string())], ["doc_id", "fingerprint"]
            )

    return docs.select("doc_id", "text").mapInArrow(digest, "doc_id long, fingerprint string")


# ---- each document beside the next one


def in_descending_order(docs: DataFrame) -> DataFrame:
    """doc_id, text, head: partitions of whole ranges of ids, each in descending order.

    The last row of a range is followed by its head row: the first document of the next
    range (after the last range: of the first). Equal ids are ordered by their text's hash,
    missing ids come last. There are at most 4096 ranges, read as streams.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.xxhash64("text").alias("tie"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(MOST_PARTS, size // STREAM_BYTES + 1)
    cuts = rows.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else []
    below = ",".join(f"{int(c)}L" for c in sorted(set(cuts)))
    rows = rows.withColumn("range", F.expr(f"coalesce(size(filter(array({below}), c -> c < doc_id)), 0)" if cuts else "0"))
    tops = rows.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("top")).orderBy(F.desc("range")).collect()
    if not tops:
        return rows.select("doc_id", "text", F.lit(0).alias("head"))
    following = [(r["range"], *tops[(i + 1) % len(tops)]["top"]) for i, r in enumerate(tops)]
    wanted = spark.createDataFrame(following, "to int, head_id long, head_tie long")
    heads = (
        rows.drop("range")
        .join(F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
        .dropDuplicates(["to"])
        .select("doc_id", "text", "tie", F.col("to").alias("range"), F.lit(1).alias("head"))
    )
    return (
        rows.withColumn("head", F.lit(0))
        .unionByName(heads)
        .repartition(len(tops), "range")
        .sortWithinPartitions(F.desc("range"), "head", F.desc_nulls_last("doc_id"), F.desc("tie"))
        .select("doc_id", "text", "head")
    )


PAIRED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def beside_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how like the next it is.

    The edited text has the last third of the code points (rounded down) replaced by the
    first as many of the next document, in descending order of doc_id.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rarity(docs))

    def pair(batches):
        digester, held = Digester(shared.value), None
        for batch in batches:
            ids, texts, heads = (c.to_pylist() for c in batch.columns)
            rows = list(zip(ids, texts, heads, digester.digests([t.encode() for t in texts]), strict=True))
            rows = ([held] if held else []) + rows
            found = [(x, y) for x, y in zip(rows, rows[1:], strict=False) if not x[2]]
            held = rows[-1] if rows else None
            edited = []
            for (_, text, _, _), (_, after, _, _) in found:
                k = len(text) // 3
                edited.append((text[: len(text) - k] + after[:k]).encode())
            out = []
            for (x, y), changed, digest in zip(found, edited, digester.digests(edited), strict=True):
                out.append(
                    (x[0], len(x[1]), hashlib.sha256(changed).hexdigest(), str(x[3]), str(digest), x[3].likeness(digest), x[3].likeness(y[3]))
                )
            columns = zip(*out, strict=True) if out else [[]] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [x.split()[0] for x in PAIRED.split(", ")])

    return in_descending_order(docs).mapInArrow(pair, PAIRED)


def entropy_plain(window: bytes) -> float:
    """Entropy of a window's bytes in bits, for tests."""
    counts = np.bincount(np.frombuffer(window, np.uint8))
    p = counts[counts > 0] / len(window)
    return float(-(p * np.log2(p)).sum())
