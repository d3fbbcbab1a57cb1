"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

Tokens are lower-cased words and one end per document. Words lie in 256 cells, in 16 groups
of 16: the 160 most frequent words and the end have cells of their own, the others share the
cell of their last two bytes, if these are a frequent ending, or one of 32 cells by a hash
of them. Cells of alike endings are neighbours, and so mostly in one group. The model is
P(word | history) = P(group | history) * P(cell | group, history) * (c + 1) / (N + V + 1),
N and V being the cell's tokens and words. The first two factors are softmaxes, each with
its own weights on four hashed features (previous word, previous two words, the word before
with one skipped, cells of the two before); the second shares its rows out to the groups by
their tokens. Words with a cell of their own are thus told apart by the history, words in
one cell by their smoothed count. Every history's probabilities sum to one, unknown words
included.

Training covers every training token in every round: tasks sum the gradient of the log
likelihood for their part, one aggregate of fixed size adds these up, and the driver moves
the weights by the gradient over its curvature bound. Counts are gathered over the whole
corpus. At most 2^18 frequent words are broadcast; counts of all others reach the
documents by a join, once per distinct text of a task. Scores need only log(c + 1) there,
so nothing else is joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.common import K2, K3, mix, split_words, stored, text_bytes

CELLS, WIDE, KINDS = 256, 16, 4
GROUPS = CELLS // WIDE
#: Rows of a kind of feature: in the softmax over groups, in the one over a group's cells.
OUTER, INNER = 4096, 8192
TABLE_ROWS = KINDS * (OUTER + INNER)
#: Words with a cell of their own, and cells that all endings share which have none.
OWN, SHARED = 160, 32
END_CELL = CELLS - 1
END, START = np.uint64(0x1F83D9ABFB41BD6B), np.uint64(0x5BE0CD19137E2179)
END_ENDING = 1 << 16
FREQUENT = 1 << 18
#: Bytes of text whose scores mostly stay in cache.
IN_CACHE = 1 << 18
HELD = 7


@dataclass
class Tokens:
    """Tokens of consecutive texts; `first[d]:first[d + 1]` are those of text d, its end last."""

    hash: np.ndarray
    ending: np.ndarray
    first: np.ndarray

    def before(self, values: np.ndarray, back: int, none) -> np.ndarray:
        out = np.empty_like(values)
        out[back:] = values[:-back] if back < len(values) else values[:0]
        for k in range(back):
            at = self.first[:-1] + k
            out[at[at < self.first[1:]]] = none
        return out


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    words = split_words(data, offsets, lower=True)
    count = np.diff(words.first)
    first = words.first + np.arange(len(offsets))
    hashes, ending = np.full(first[-1], END), np.full(first[-1], END_ENDING, np.int32)
    at = np.arange(len(words.start)) + np.repeat(np.arange(len(count)), count)
    hashes[at] = words.hashes()
    last = words.start + words.length - 1
    before = np.where(words.length > 1, words.data[np.maximum(last - 1, 0)] if len(last) else 0, 0)
    ending[at] = before.astype(np.int32) << 8 | (words.data[last] if len(last) else 0)
    return Tokens(hashes, ending, first)


@dataclass
class Cells:
    """Where words lie, and which rows of a kind the cells of each group have."""

    words: np.ndarray  # hashes of the words with a cell of their own, sorted
    own: np.ndarray
    of_ending: np.ndarray
    start: np.ndarray  # by group
    rows: np.ndarray

    def of(self, t: Tokens) -> np.ndarray:
        cell = self.of_ending[t.ending]
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, t.hash), len(self.words) - 1)
            cell = np.where(self.words[at] == t.hash, self.own[at], cell)
        return cell

    def group_of_row(self) -> np.ndarray:
        return np.repeat(np.arange(GROUPS), self.rows)


def choose_cells(endings: pd.DataFrame, top: pd.DataFrame) -> tuple[Cells, np.ndarray, np.ndarray]:
    """Cells of the words, and tokens and distinct words of each cell.

    `endings`: ending, n, v (all tokens and words with it); `top`: frequent words.
    """
    own = top[top["ending"] != END_ENDING].sort_values(["n", "word"], ascending=[False, True])[:OWN]
    inside = own.groupby("ending")["n"].agg(["sum", "count"]).reindex(endings["ending"], fill_value=0)
    n = endings["n"].to_numpy(np.int64) - inside["sum"].to_numpy(np.int64)
    v = endings["v"].to_numpy(np.int64) - inside["count"].to_numpy(np.int64)
    ending = endings["ending"].to_numpy(np.int64)
    named = [e for e in ending[np.lexsort((ending, -n))] if e != END_ENDING][: END_CELL - OWN - SHARED]

    alike = lambda e: (int(e) & 255, int(e) >> 8)
    units = [(*alike(e), 0, int(e)) for e in named] + [(*alike(e), 1, i) for i, e in enumerate(own["ending"])]
    of_ending = np.empty(END_ENDING + 1, np.int32)
    shared = (mix(np.arange(END_ENDING + 1, dtype=np.uint64) + K2) % np.uint64(SHARED)).astype(np.int32)
    of_ending[:] = END_CELL - SHARED + shared
    of_ending[END_ENDING] = END_CELL
    cell_of_own = np.zeros(len(own), np.int32)
    for cell, (_, _, single, what) in enumerate(sorted(units)):
        (cell_of_own if single else of_ending)[what] = cell
    tokens_in = np.bincount(of_ending[ending], n, CELLS) + np.bincount(cell_of_own, own["n"].to_numpy(float), CELLS)
    words_in = np.bincount(of_ending[ending], v, CELLS) + np.bincount(cell_of_own, minlength=CELLS)

    by_group = tokens_in.reshape(GROUPS, WIDE).sum(1)
    rows = 1 + ((INNER - GROUPS) * by_group / max(by_group.sum(), 1)).astype(np.int64)
    rows[np.argmax(rows)] += INNER - rows.sum()
    hashes = own["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Cells(hashes[order], cell_of_own[order], of_ending, np.cumsum(rows) - rows, rows), tokens_in, words_in


def features(t: Tokens, cell: np.ndarray, cells: Cells) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Rows of the weight table of each token's history, by kind: over groups, over cells."""
    one, two = t.before(t.hash, 1, START), t.before(t.hash, 2, START)
    near, far = t.before(cell, 1, END_CELL), t.before(cell, 2, END_CELL)
    group = cell // WIDE
    rows, start = cells.rows.astype(np.uint64)[group], cells.start[group]
    outer, inner = [], []
    for k, x in enumerate((one, one * K2 + two, two, (near * CELLS + far).astype(np.uint64) + K3)):
        h = mix(x)
        outer.append(k * OUTER + (h >> np.uint64(64 - 12)).astype(np.int64))
        low = ((h & np.uint64(0xFFFFFFFF)) * rows >> np.uint64(32)).astype(np.int64)
        inner.append(KINDS * OUTER + k * INNER + start + low)
    return outer, inner


def _raised(table: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Logits of every token and choice, and their exponentials' sums.

    A weight moves by at most one a round, so no exponential leaves the range of floats.
    """
    z = table.take(rows[0], 0)
    for r in rows[1:]:
        z += table.take(r, 0)
    return z, np.exp(z) @ np.ones(WIDE, z.dtype)


def history_logs(table: np.ndarray, cells: Cells, t: Tokens, cell: np.ndarray) -> np.ndarray:
    """log P(cell | history) of every token's own cell."""
    out = np.zeros(len(cell))
    for rows, choice in zip(features(t, cell, cells), (cell // WIDE, cell % WIDE), strict=True):
        z, total = _raised(table, rows)
        out += z[np.arange(len(cell)), choice] - np.log(total)
    return out


def _pieces(column: pa.Array, limit: int = 1 << 20):
    data, offsets = text_bytes(column)
    for low, high in common.pieces(offsets, limit):
        yield low, high, tokens(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])


def _merged(hashes: np.ndarray, ending: np.ndarray, n: np.ndarray):
    keys, one, at = np.unique(hashes, return_index=True, return_inverse=True)
    return keys, ending[one], np.bincount(at, n, len(keys)).astype(np.int64)


def _counts(batches, most: int = 1 << 20):
    """(word, ending, n) of a task's tokens; flushed when there are many distinct words."""
    held = (np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64))
    out = lambda: pa.record_batch([pa.array(held[0].view(np.int64)), pa.array(held[1]), pa.array(held[2])], ["word", "ending", "n"])
    for batch in batches:
        parts = [held]
        for _, _, t in _pieces(batch.column(0)):
            parts.append(_merged(t.hash, t.ending, np.ones(len(t.hash), np.int64)))
        held = _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        if len(held[0]) > most:
            yield out()
            held = tuple(x[:0] for x in held)
    yield out()


def _spans() -> list[tuple[int, int]]:
    """Where the rows of each kind begin in the table, and how many there are."""
    outer = [(k * OUTER, OUTER) for k in range(KINDS)]
    return outer + [(KINDS * OUTER + k * INNER, INNER) for k in range(KINDS)]


def _observed(batches, cells: Cells):
    """Per row of the weight table, a task's tokens of each choice; the same in every round."""
    seen = np.zeros((TABLE_ROWS, WIDE))
    for batch in batches:
        for _, _, t in _pieces(batch.column(0)):
            cell = cells.of(t)
            outer, inner = features(t, cell, cells)
            choices = [cell // WIDE] * KINDS + [cell % WIDE] * KINDS
            for rows, choice, (low, many) in zip(outer + inner, choices, _spans(), strict=True):
                at = (rows - low) * WIDE + choice
                seen[low : low + many] += np.bincount(at, minlength=many * WIDE).reshape(-1, WIDE)
    yield from _table(seen)


def _expected(batches, cells: Cells, table: np.ndarray):
    """The same as the model expects them, summed over a task's histories."""
    total = np.zeros((WIDE, TABLE_ROWS))
    for batch in batches:
        for _, _, t in _pieces(batch.column(0), IN_CACHE):
            outer, inner = features(t, cells.of(t), cells)
            shares = [_shares(table, outer)] * KINDS + [_shares(table, inner)] * KINDS
            for rows, p, (low, many) in zip(outer + inner, shares, _spans(), strict=True):
                for own, weight in zip(total, p, strict=True):
                    own[low : low + many] += np.bincount(rows - low, weight, many)
    yield from _table(total.T)


def _shares(table: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Every choice's probability for each token, one choice after the other."""
    z, sums = _raised(table, rows)
    p = np.ascontiguousarray(np.exp(z, out=z).T, np.float64)
    p /= sums
    return p


def _table(sums: np.ndarray):
    some = np.flatnonzero(sums.any(1))
    yield pa.record_batch([pa.array(some), *(pa.array(sums[some, k]) for k in range(WIDE))], ["row", *COLUMNS])


def _summed(parts: DataFrame) -> np.ndarray:
    """The tasks' tables added up: at most TABLE_ROWS rows, whatever the corpus is."""
    rows = parts.groupBy("row").agg(*(F.sum(x).alias(x) for x in COLUMNS)).toPandas()
    out = np.zeros((TABLE_ROWS, WIDE))
    out[rows["row"].to_numpy()] = rows[COLUMNS].to_numpy()
    return out


COLUMNS = [f"c{k}" for k in range(WIDE)]
TABLE = "row long, " + ", ".join(f"{x} double" for x in COLUMNS)


@dataclass
class Model:
    cells: Cells
    table: np.ndarray  # logits of no history are in the rows of the first kind
    cell_total: np.ndarray  # N + V + 1 of each cell
    words: np.ndarray  # the most frequent words, sorted, and their counts
    counts: np.ndarray
    total: int
    distinct: int


def fit(training: DataFrame, vocabulary: DataFrame, rounds: int = 3, prior: float = 12.0) -> Model:
    """Trains on every token of `training` (column text); `vocabulary`: word, ending, n."""
    if rounds > 20:
        raise ValueError("more than 20 rounds may leave the range of single floats")
    top = frequent_words(vocabulary).toPandas()
    endings = vocabulary.groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    cells, tokens_in, words_in = choose_cells(endings, top)
    total = int(tokens_in.sum())
    by_group = tokens_in.reshape(GROUPS, WIDE).sum(1)
    outer = (by_group + 1) / (total + GROUPS)
    inner = (tokens_in.reshape(GROUPS, WIDE) + 1) / (by_group[:, None] + WIDE)
    per_row = inner[cells.group_of_row()]
    share = np.concatenate([np.broadcast_to(outer, (KINDS * OUTER, WIDE)), np.tile(per_row, (KINDS, 1))])
    bias = np.zeros((TABLE_ROWS, WIDE))
    bias[:OUTER], bias[KINDS * OUTER :][:INNER] = np.log(outer), np.log(per_row)
    table = bias.astype(np.float32)
    context, texts = training.sparkSession.sparkContext, training.select("text")
    if total:
        seen = _summed(texts.mapInArrow(lambda b: _observed(b, cells), TABLE))
    for k in range(rounds if total else 0):
        if k:
            now = context.broadcast(table)
            expected = _summed(texts.mapInArrow(lambda b, now=now: _expected(b, cells, now.value), TABLE))
            now.destroy()
        else:
            expected = seen.sum(1, keepdims=True) * share  # of weights that are all zero
        step = (seen - expected) / (np.maximum(seen, expected) + prior)
        table = table + step.astype(np.float32) / (1 if k else 2)
    words = top["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    counts = top["n"].to_numpy(np.int64)[order]
    return Model(cells, table, tokens_in + words_in + 1, words[order], counts, total, int(endings["v"].sum()))


def frequent_words(vocabulary: DataFrame) -> DataFrame:
    """The words above a count, the lowest that at most `FREQUENT` words are above.

    Counts fall into sixteen classes per doubling, so a thousand sums decide, and no task
    gathers the top of every partition.
    """
    level = F.floor(F.log2("n") * 16)
    sizes = vocabulary.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()
    least, taken = None, 0
    for row in sorted(sizes, key=lambda r: -r["level"]):
        taken += row["words"]
        if taken > FREQUENT:
            break
        least = row["level"]
    if least is None:
        return vocabulary.select("word", "ending", "n").limit(0)
    return vocabulary.filter(level >= least).select("word", "ending", "n")


def _frequent(model: Model, hashes: np.ndarray) -> np.ndarray:
    """Counts of the frequent words, -1 for others."""
    if not len(model.words):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(model.words, hashes), len(model.words) - 1)
    return np.where(model.words[at] == hashes, model.counts[at], -1)


def _text_key(hashes: np.ndarray) -> int:
    place = mix(np.arange(len(hashes), dtype=np.uint64) + K2)
    return int(mix(mix(hashes + place).sum(keepdims=True)).view(np.int64)[0])


def _documents(batches, shared):
    model = shared.value
    smooth = np.log(model.cell_total)
    for batch in batches:
        held = common.held_out(batch.column(0), HELD)
        n, known, logs, gain, key = [], [], [], [], []
        for _, _, t in _pieces(batch.column(1), IN_CACHE):
            cell = model.cells.of(t)
            value = history_logs(model.table, model.cells, t, cell) - smooth[cell]
            count = _frequent(model, t.hash)
            begin = t.first[:-1]
            n.append(np.diff(t.first))
            known.append(np.add.reduceat((count > 0).astype(np.int64), begin))
            logs.append(np.add.reduceat(np.log10(np.maximum(count, 0) + 1.0), begin))
            gain.append(np.add.reduceat(value.astype(np.float64), begin) / np.log(10))
            key.append([_text_key(t.hash[a:b]) for a, b in zip(begin, t.first[1:], strict=True)])
        flat = lambda x, kind: pa.array(np.concatenate(x) if x else np.zeros(0), kind)
        yield pa.record_batch(
            [batch.column(0), pa.array(held), flat(n, pa.int64()), flat(known, pa.int64()), flat(logs, pa.float64()), flat(gain, pa.float64()), flat([np.array(k, np.int64) for k in key], pa.int64())],
            ["doc_id", "held_out", "n_tokens", "n_known", "logs", "gain", "key"],
        )


def _rare(batches, shared):
    """(text key, word, times) of words that are not frequent, once per text of a task."""
    model, done = shared.value, set()
    for batch in batches:
        for _, _, t in _pieces(batch.column(0)):
            new = np.zeros(len(t.first) - 1, bool)
            keys = np.zeros(len(new), np.int64)
            for d, (a, b) in enumerate(zip(t.first, t.first[1:])):
                keys[d] = k = _text_key(t.hash[a:b])
                new[d] = k not in done
                done.add(k)
            doc = np.repeat(np.arange(len(new)), np.diff(t.first))
            keep = np.flatnonzero(new[doc] & (_frequent(model, t.hash) < 0))
            if not len(keep):
                continue
            order = keep[np.lexsort((t.hash[keep], doc[keep]))]
            h, d = t.hash[order], doc[order]
            begin = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])]))
            times = np.diff(np.append(begin, len(h)))
            yield pa.record_batch(
                [pa.array(keys[d[begin]]), pa.array(h[begin].view(np.int64)), pa.array(times, pa.int32())], ["key", "word", "times"]
            )


def lm_scores(docs: DataFrame, rounds: int = 3) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the documents whose crc32(doc_id as text) mod 7 is not 2; a missing id counts
    as empty text there. Null and empty texts are one end token. Scores are log10
    probabilities of the whole text, under add-one unigram counts and under the model. Other
    columns are ignored; without training rows every word is unknown to both.
    """
    spark = docs.sparkSession
    base = docs.select("doc_id", "text")
    of_id = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0))
    training = base.filter(of_id % HELD != 2)
    vocabulary = stored(
        training.select("text")
        .mapInArrow(_counts, "word long, ending int, n long")
        .groupBy("word")
        .agg(F.max("ending").alias("ending"), F.sum("n").alias("n")),
        "vocabulary",
    )
    model = fit(training, vocabulary, rounds)
    shared = spark.sparkContext.broadcast(model)
    rare = (
        base.select("text")
        .mapInArrow(lambda b: _rare(b, shared), "key long, word long, times int")
        .join(vocabulary.select("word", "n"), "word")
        .groupBy("key", "word")
        .agg(F.max("times").alias("times"), F.max("n").alias("n"))
        .groupBy("key")
        .agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    )
    rows = base.mapInArrow(
        lambda b: _documents(b, shared),
        "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, gain double, key long",
    )
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    whole = float(np.log10(model.total + model.distinct + 1))
    return rows.join(rare, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(whole)).alias("base_score"),
        (logs + F.col("gain")).alias("score"),
    )


def base_plain(docs: pd.DataFrame, held: dict) -> dict:
    """doc_id to (n_tokens, n_known, train_tokens, base_score) from plain counts, for tests."""
    words = {d: [*(t or "").encode().lower().split(), None] for d, t in zip(docs["doc_id"], docs["text"], strict=True)}
    counts: dict = {}
    for d, w in words.items():
        for x in w if not held[d] else ():
            counts[x] = counts.get(x, 0) + 1
    total = sum(counts.values())
    out = {}
    for d, w in words.items():
        score = sum(np.log10((counts.get(x, 0) + 1) / (total + len(counts) + 1)) for x in w)
        out[d] = (len(w), sum(x in counts for x in w), total, score)
    return out
