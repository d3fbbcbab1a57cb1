"""Removal of word passages that also stand in an earlier document.

A window is `window` consecutive words; every word covered by a window whose word sequence
also begins in a document with a smaller doc_id goes. Suffix automata of reference passages
give, for each place of a document, the longest match (matching statistics) and the first
document that has it; maximal runs of matches of `window` words or more are removed.

The references are the corpus itself, so they grow with it and cannot be broadcast. They
are sharded by content instead. The anchor of a window is the smallest hash among its
six-word sequences; equal windows have equal anchors, and neighbouring windows mostly share
theirs. Windows whose anchor stands in one text only cannot repeat and are dropped (one
aggregate with map-side sums). Runs of windows with one anchor meet in one place, in order
of doc_id; there the earlier runs form the automaton and each run is streamed through it.
Runs that were seen before are neither inserted nor streamed again: a later document loses
them whole, another place in the same document loses what the first place did.

Anchors with more than 1/16384 of all runs, and more than 32768 runs, are hot (there are at
most 16384 of them). Their windows are counted by one aggregate per window, with map-side minima, and joined back;
that join is split by Spark where it is skewed. Results are exact on both ways.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import common
from ledgerlens.llm.common import ngram_hashes, split_words, stored, text_bytes

ANCHOR = 6
#: A group of so many runs is streamed through its automaton by one task in about a second
#: and holds some hundred megabytes at worst; larger ones are hot if they pass the share.
HOT_SHARE, HOT_LEAST = 1 << 14, 1 << 15


class SuffixAutomaton:
    """Of several sequences; a state knows the first sequence's owner that reached it.

    Sequences are added in ascending order of owner, so the first owner is the smallest.
    """

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.owner = [-1], [0], [None]

    def _state(self, size: int, follow: dict[int, int], link: int, owner) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.size.append(size)
        self.owner.append(owner)
        return len(self.size) - 1

    def _split(self, p: int, c: int) -> int:
        """The state for the longest suffix of p's text with c appended."""
        q = self.next[p][c]
        if self.size[q] == self.size[p] + 1:
            return q
        clone = self._state(self.size[p] + 1, dict(self.next[q]), self.link[q], self.owner[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int], owner) -> None:
        last = 0
        for c in sequence:
            if c in self.next[last]:
                last = self._split(last, c)
                continue
            new, p = self._state(self.size[last] + 1, {}, 0, owner), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def first_owners(self, sequence: list[int], window: int):
        """Per place, who first has the `window` items that end there (None: nobody)."""
        state = length = 0
        for c in sequence:
            while state and c not in self.next[state]:
                state = self.link[state]
                length = self.size[state]
            if c in self.next[state]:
                state, length = self.next[state][c], length + 1
            if length < window:
                yield None
                continue
            while self.size[self.link[state]] >= window:
                state = self.link[state]
                length = self.size[state]
            yield self.owner[state]


def sequence_hash(words: np.ndarray) -> int:
    """Stands for a whole text's word sequence; 0 for no words."""
    if not len(words):
        return 0
    place = common.mix(np.arange(len(words), dtype=np.uint64) + common.K1)
    return int(common.mix(common.mix(words + place).sum(keepdims=True)).view(np.int64)[0]) or 1


def _texts(column: pa.Array):
    """(first text, words, word hashes) of pieces of a column."""
    data, offsets = text_bytes(column)
    for low, high in common.pieces(offsets):
        words = split_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        yield low, words, words.hashes()


def runs(hashes: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: text, first window, windows, anchor hash."""
    anchor = min(ANCHOR, window)
    value = ngram_hashes(hashes, anchor)
    place = np.arange(len(value))
    spread, reach = window - anchor + 1, 1
    while reach < spread and len(value):
        step = min(reach, spread - reach)
        left = value[:-step] <= value[step:]
        value = np.where(left, value[:-step], value[step:])
        place = np.where(left, place[:-step], place[step:])
        reach += step
    count = np.maximum(np.diff(first) - window + 1, 0)
    text = np.repeat(np.arange(len(count)), count)
    at = np.repeat(first[:-1], count) + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    if not len(at):
        return at, at, at, np.zeros(0, np.uint64)
    begin = np.flatnonzero(np.concatenate([[True], (place[at[1:]] != place[at[:-1]]) | (text[1:] != text[:-1])]))
    return text[begin], at[begin], np.diff(np.append(begin, len(at))), value[at[begin]]


@common.frugal
def _sequences(batches):
    for batch in batches:
        out = [sequence_hash(h[a:b]) for _, w, h in _texts(batch.column(1)) for a, b in zip(w.first, w.first[1:])]
        yield pa.record_batch([batch.column(0), pa.array(out, pa.int64())], ["doc_id", "seq"])


@common.frugal
def _anchors(batches, window: int):
    seen: set[int] = set()
    for batch in batches:
        for _, words, hashes in _texts(batch.column(0)):
            text, _, _, anchor = runs(hashes, words.first, window)
            seqs = np.array([sequence_hash(hashes[a:b]) for a, b in zip(words.first, words.first[1:])], np.int64)
            new = np.array([not (s in seen or seen.add(s)) for s in seqs.tolist()], bool)
            keep = new[text]
            yield pa.record_batch([pa.array(anchor[keep].view(np.int64)), pa.array(seqs[text[keep]])], ["anchor", "seq"])


@common.frugal
def _live_runs(batches, window: int, live):
    """Runs under anchors that the filter admits; of equal texts the smallest doc_id so far."""
    seen: dict[int, int] = {}
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for low, words, hashes in _texts(batch.column(1)):
            text, begin, count, anchor = runs(hashes, words.first, window)
            new = np.zeros(len(words.first) - 1, bool)
            seqs = np.zeros(len(new), np.int64)
            for d, (a, b) in enumerate(zip(words.first, words.first[1:])):
                seqs[d] = s = sequence_hash(hashes[a:b])
                if ids[low + d] is not None and seen.get(s, 1 << 63) > ids[low + d]:
                    new[d], seen[s] = True, ids[low + d]
            keep = np.flatnonzero(new[text])
            keep = keep[common.admitted(anchor[keep].view(np.int64), live.value)]
            if not len(keep):
                continue
            size = count[keep] + window - 1
            total = np.concatenate([[0], np.cumsum(size)])
            flat = hashes[np.repeat(begin[keep] - total[:-1], size) + np.arange(total[-1])]
            blobs = pa.Array.from_buffers(
                pa.large_binary(), len(keep), [None, pa.py_buffer((total * 8).astype(np.int64)), pa.py_buffer(flat)]
            ).cast(pa.binary())
            owner = np.array([x or 0 for x in ids[low : low + len(new)]], np.int64)
            yield pa.record_batch(
                [
                    pa.array(anchor[keep].view(np.int64)),
                    pa.array(owner[text[keep]]),
                    pa.array(seqs[text[keep]]),
                    pa.array((begin - words.first[text])[keep], pa.int32()),
                    blobs,
                ],
                ["anchor", "doc_id", "seq", "start", "words"],
            )


RUN = "anchor long, doc_id long, seq long, start int, words binary"
FOUND = "doc_id long, seq long, start int, mask int"


@common.frugal
def _match(batches, window: int):
    """Rows sorted by anchor and doc_id: windows of each run that an earlier document has."""
    key = object()
    for batch in batches:
        out: list[tuple] = []
        for anchor, doc, seq, start, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if anchor != key:
                key, known, automaton, single = anchor, {}, None, None
            if words in known:
                first, mask = known[words]
                if first < doc:
                    mask = (1 << len(words) // 8 - window + 1) - 1
                if mask:
                    out.append((doc, seq, start, mask))
                continue
            items = np.frombuffer(words, np.int64).tolist()
            if automaton is None:
                if single is None:
                    known[words], single = (doc, 0), (items, doc)
                    continue
                automaton = SuffixAutomaton()
                automaton.add(*single)
            mask = 0
            for i, owner in enumerate(automaton.first_owners(items, window)):
                if owner is not None and owner < doc:
                    mask |= 1 << (i - window + 1)
            known[words] = doc, mask
            if mask:
                out.append((doc, seq, start, mask))
            automaton.add(items, doc)
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            ["doc_id", "seq", "start", "mask"],
        )


@common.frugal
def _windows(batches, window: int):
    for batch in batches:
        rows = []
        for doc, seq, start, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for i, h in enumerate(ngram_hashes(np.frombuffer(words, np.uint64), window).view(np.int64).tolist()):
                rows.append((h, doc, seq, start + i))
        yield pa.record_batch(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.int64(), pa.int64(), pa.int32()))],
            ["window", "doc_id", "seq", "start"],
        )


def _kept(words: list[bytes], found, window: int) -> tuple[int, bytes]:
    gone = np.zeros(len(words) + 1, np.int64)
    for start, mask in found:
        for i in range(mask.bit_length()):
            if mask >> i & 1:
                gone[start + i] += 1
                gone[min(start + i + window, len(words))] -= 1
    away = np.cumsum(gone[:-1]) > 0
    return int(away.sum()), b" ".join(w for w, a in zip(words, away.tolist()) if not a)


def _outcome(batch, window: int, touched=None):
    """A batch of (doc_id, text, rest[, seq, first_id, found]) to result rows."""
    n_words, n_removed, kept = [], [], []
    ids, texts = batch.column(0).to_pylist(), common.text_array(batch.column(1)).to_pylist()
    firsts, spans = (batch.column(4).to_pylist(), batch.column(5).to_pylist()) if touched else ([None] * len(ids),) * 2
    for doc, text, first, found in zip(ids, texts, firsts, spans, strict=True):
        words = text.encode().split()
        gone, left = 0, None
        if first is not None and doc is not None:
            if first < doc and len(words) >= window:
                gone, left = len(words), b""
            elif first == doc and found:
                gone, left = _kept(words, [(x["start"], x["mask"]) for x in found], window)
        n_words.append(len(words))
        n_removed.append(gone)
        kept.append((b" ".join(words) if left is None else left).decode())
    return pa.record_batch(
        [batch.column(0), batch.column(1), batch.column(2), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
        ["doc_id", "text", "rest", "n_words", "n_removed", "kept"],
    )


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def substring_dedup(docs: DataFrame, window: int = 13) -> DataFrame:
    """All rows and columns of `docs`, with n_words, n_removed and kept (words left, joined).

    Columns of these three names are replaced. A null text has no words. A null doc_id is
    neither smaller nor larger than another: its row loses nothing and takes nothing from
    others. Rows of one doc_id take nothing from each other. `window` is 13 to 31 words.
    """
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text", "n_words", "n_removed", "kept")]
    base = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("rest"))
    pairs = base.select("doc_id", "text")

    classes = (
        pairs.filter("doc_id is not null")
        .mapInArrow(_sequences, "doc_id long, seq long")
        .groupBy("seq")
        .agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    )
    classes = stored(classes.filter("seq <> 0"), "texts")
    anchors = (
        pairs.filter("doc_id is not null")
        .select("text")
        .mapInArrow(lambda b: _anchors(b, window), "anchor long, seq long")
        .groupBy("anchor")
        .agg(F.min("seq").alias("l"), F.max("seq").alias("h"), F.count("*").alias("n"))
        .filter("l <> h")
        .select("anchor", "n")
    )
    anchors = stored(anchors, "anchors")
    common.let_go(spark)
    total = anchors.agg(F.sum("n")).first()[0] or 0
    hot = anchors.filter(F.col("n") > max(HOT_LEAST, total // HOT_SHARE)).select("anchor")
    live = spark.sparkContext.broadcast(common.key_filter(anchors, "anchor"))
    found_runs = stored(pairs.mapInArrow(lambda b: _live_runs(b, window, live), RUN), "runs")
    common.let_go(spark)

    usual = found_runs.join(F.broadcast(hot), "anchor", "left_anti").select("anchor", "doc_id", "seq", "start", "words")
    matched = (
        usual.repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id")
        .mapInArrow(lambda b: _match(b, window), FOUND)
    )
    windows = (
        found_runs.join(F.broadcast(hot), "anchor", "left_semi")
        .select("doc_id", "seq", "start", "words")
        .mapInArrow(lambda b: _windows(b, window), "window long, doc_id long, seq long, start int")
    )
    earliest = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    repeated = windows.join(earliest.filter("least < most"), "window").filter("least < doc_id")
    found = matched.unionByName(repeated.select("doc_id", "seq", "start", F.lit(1).alias("mask")))
    spans = (
        found.groupBy("seq", F.col("doc_id").alias("first_id"))
        .agg(F.collect_list(F.struct("start", "mask")).alias("found"))
    )
    touched = stored(
        classes.join(spans, ["seq", "first_id"], "left")
        .filter("first_id < last_id or found is not null")
        .select("seq", "first_id", "found"),
        "touched",
    )

    listed = spark.sparkContext.broadcast(common.key_filter(touched, "seq", 22))
    carried = [base.schema[c] for c in ("doc_id", "text", "rest")]
    result = T.StructType([*carried, *_fields("n_words long, n_removed long, kept string")])

    @common.frugal
    def split(batches, wanted: bool):
        for batch in batches:
            seqs = np.array(
                [sequence_hash(h[a:b]) for _, w, h in _texts(batch.column(1)) for a, b in zip(w.first, w.first[1:])], np.int64
            )
            take = common.admitted(seqs, listed.value) if len(seqs) else np.zeros(0, bool)
            some = batch.filter(pa.array(take if wanted else ~take))
            if wanted:
                yield pa.record_batch([*some.columns, pa.array(seqs[take])], ["doc_id", "text", "rest", "seq"])
            elif some.num_rows:
                yield _outcome(some, window)

    clean = base.mapInArrow(lambda b: split(b, False), result)
    placed = base.mapInArrow(lambda b: split(b, True), T.StructType([*carried, *_fields("seq long")])).join(touched, "seq", "left")
    marked = placed.select("doc_id", "text", "rest", "seq", "first_id", "found").mapInArrow(
        lambda batches: (_outcome(b, window, touched=True) for b in batches), result
    )
    both = clean.unionByName(marked)
    names = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept")]
    named = [F.col(c) if c in ("doc_id", "text") else F.col(f"rest.`{c}`").alias(c) for c in names]
    return both.select(*named, "n_words", "n_removed", "kept")


def brute_force(docs: pd.DataFrame, window: int = 13) -> dict[int, tuple[int, int, str]]:
    """doc_id to (n_words, n_removed, kept_sha256) from a dictionary of all windows, for tests."""
    words = {d: (t or "").encode().split() for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    first: dict[tuple, int] = {}
    for d in sorted(words):
        w = words[d]
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i : i + window]), d)
    out = {}
    for d, w in words.items():
        away = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < d:
                away[i : i + window] = [True] * window
        kept = b" ".join(x for x, a in zip(w, away) if not a)
        out[d] = (len(w), sum(away), hashlib.sha256(kept).hexdigest())
    return out
