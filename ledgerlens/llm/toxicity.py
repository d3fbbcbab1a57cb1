"""Toxicity: subword-bag embeddings, averaged over word windows, into a linear softmax.

A word is the bag of its byte n-grams (with border marks) and of itself, hashed to rows of
one embedding table; unseen misspellings share most rows with the word they come from. The
embeddings of a window of words are averaged and go into a softmax over two classes; a
document has the probability of its most toxic window, so one insult counts in a long text
too. Embeddings and softmax are trained jointly in numpy: a first AdaGrad step over whole
documents, then epochs in which each document's gradient goes through its top window.

The two-class softmax needs only the difference of its two rows, so scoring reads one
number per hashed n-gram, and every distinct word of a batch is looked up once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import common
from ledgerlens.llm.common import KEEP, mix, split_words, text_bytes

BUCKET_BITS = 17
GRAMS = (3, 4, 5)
WORDS_AT_ONCE = 1 << 13


@dataclass
class Bags:
    """Texts as words of `word[first[d]:first[d + 1]]`; word w has rows[bag[w]:bag[w + 1]]."""

    word: np.ndarray
    first: np.ndarray
    rows: np.ndarray
    bag: np.ndarray


def subwords(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed rows of each word's n-grams, and where each word's rows begin."""
    size = length + 2
    begin = np.concatenate([[0], np.cumsum(size)])
    wrapped = np.full(begin[-1] + 8, ord("<"), np.uint8)
    within = np.arange(begin[-1]) - np.repeat(begin[:-1], size)
    inner = (within > 0) & (within < np.repeat(size, size) - 1)
    source = np.repeat(start, size) + within - 1
    wrapped[:-8][inner] = data[source[inner]]
    wrapped[begin[1:] - 1] = ord(">")
    eights = np.ndarray((len(wrapped) - 7,), "<u8", wrapped, strides=(1,))
    owner = np.repeat(np.arange(len(start)), size)
    left = np.repeat(size, size) - within
    owners, rows = [np.arange(len(start))], [common.hash_slices(data, start, length)]
    for n in GRAMS:
        at = np.flatnonzero(left >= n)
        owners.append(owner[at])
        rows.append(mix((eights[at] & KEEP[n]) ^ np.uint64(n << 56)))
    owners, rows = np.concatenate(owners), np.concatenate(rows) >> np.uint64(64 - BUCKET_BITS)
    order = np.argsort(owners, kind="stable")
    return rows[order].astype(np.int32), np.searchsorted(owners[order], np.arange(len(start) + 1))


def bags(data: np.ndarray, offsets: np.ndarray) -> Bags:
    """Words and n-grams of texts, made from pieces of about two megabytes.

    Beside the result, memory holds a hash per word and what one piece needs.
    """
    seen, new_keys = np.zeros(0, np.uint64), [np.zeros(0, np.uint64)]
    hashes, count = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    rows, size = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for low, high in common.pieces(offsets):
        words = split_words(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], lower=True)
        hashes.append(words.hashes())
        count.append(np.diff(words.first))
        keys, one = np.unique(hashes[-1], return_index=True)
        fresh = ~np.isin(keys, seen, assume_unique=True)
        seen = np.union1d(seen, keys)
        new_keys.append(keys[fresh])
        for some in np.array_split(one[fresh], int(fresh.sum()) // WORDS_AT_ONCE + 1):
            part, first = subwords(words.data, words.start[some], words.length[some])
            rows.append(part)
            size.append(np.diff(first))
    # Words are numbered as they came; `seen` is in order of their hashes.
    number = np.argsort(np.concatenate(new_keys)).astype(np.int32)
    word = np.concatenate([number[np.searchsorted(seen, h)] for h in hashes])
    first = np.concatenate([[0], np.cumsum(np.concatenate(count))])
    return Bags(word, first, np.concatenate(rows), np.concatenate([[0], np.cumsum(np.concatenate(size))]))


@dataclass
class Model:
    """`weight`: what a hashed n-gram adds to the difference of the class scores."""

    weight: np.ndarray
    bias: float
    window: int

    def word_scores(self, x: Bags) -> np.ndarray:
        if len(x.bag) < 2:
            return np.zeros(0)
        return np.add.reduceat(self.weight[x.rows].astype(np.float64), x.bag[:-1]) / np.diff(x.bag)

    def top_windows(self, x: Bags) -> tuple[np.ndarray, np.ndarray]:
        """Per text the score of its top window (no words: 0) and where that begins."""
        total = np.concatenate([[0.0], np.cumsum(self.word_scores(x)[x.word])])
        score, begin = np.zeros(len(x.first) - 1), x.first[:-1].copy()
        for d, (low, high) in enumerate(zip(x.first[:-1], x.first[1:], strict=True)):
            if high - low > self.window:
                sums = total[low + self.window : high + 1] - total[low : high + 1 - self.window]
                begin[d] = low + (at := int(np.argmax(sums)))
                score[d] = sums[at] / self.window
            elif high > low:
                score[d] = (total[high] - total[low]) / (high - low)
        return score, begin

    def probabilities(self, texts: pa.Array) -> np.ndarray:
        data, offsets = text_bytes(texts)
        out = np.zeros(len(offsets) - 1)
        for low, high in common.pieces(offsets):
            part = bags(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            out[low:high] = self.top_windows(part)[0]
        return 1 / (1 + np.exp(-np.clip(out + self.bias, -50, 50)))


def train(
    texts: pa.Array, label: np.ndarray, window: int = 3, size: int = 16, epochs: int = 12, rate: float = 0.25
) -> Model:
    """Fits on labelled texts; without both labels every text gets the smoothed base rate."""
    label = np.asarray(label, float)
    base = (label.sum() + 0.5) / (len(label) + 1)
    if not 0 < label.sum() < len(label):
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(base / (1 - base))), window)
    random = np.random.default_rng(1)
    embedding = random.normal(0, 0.05, (1 << BUCKET_BITS, size)).astype(np.float32)
    out = random.normal(0, 1, (2, size)).astype(np.float32)
    x = bags(*text_bytes(texts))
    embedding += _first_step(x, label - label.mean())[:, None] * ((out[1] - out[0]) / (out[1] - out[0]).dot(out[1] - out[0]))
    seen_e, seen_o, bias, seen_b = np.full(len(embedding), 1e-2, np.float32), np.full((2, 1), 1e-2, np.float32), 0.0, 1e-2
    weigh = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    for _ in range(epochs):
        for docs in np.array_split(random.permutation(len(label)), max(1, len(label) // 64)):
            model = Model(embedding @ (out[1] - out[0]), bias, window)
            part = _some(x, docs)
            score, begin = model.top_windows(part)
            error = (label[docs] - 1 / (1 + np.exp(-np.clip(score + bias, -50, 50)))) * weigh[docs]
            size_of = np.minimum(np.diff(part.first), window)
            has = np.flatnonzero(size_of)
            if not len(has):
                continue
            place = np.concatenate([np.arange(begin[d], begin[d] + size_of[d]) for d in has])
            owner = np.repeat(has, size_of[has])
            word = part.word[place]
            count = part.bag[word + 1] - part.bag[word]
            share = np.repeat(error[owner] / size_of[owner] / count, count).astype(np.float32)
            gram = part.rows[np.concatenate([np.arange(part.bag[w], part.bag[w + 1]) for w in word])]
            bag = share @ embedding[gram]
            step = np.bincount(gram, share, len(embedding)).astype(np.float32)
            seen_e += step**2
            moved = np.flatnonzero(step)
            embedding[moved] += (rate * step[moved] / np.sqrt(seen_e[moved]))[:, None] * (out[1] - out[0])
            for c, sign in ((1, 1), (0, -1)):
                seen_o[c] += bag.dot(bag)
                out[c] += 0.1 * rate * sign * bag / np.sqrt(seen_o[c])
            seen_b += error.sum() ** 2
            bias += rate * error.sum() / seen_b**0.5
    return Model((embedding @ (out[1] - out[0])).astype(np.float32), float(bias), window)


def _some(x: Bags, docs: np.ndarray) -> Bags:
    """The given texts only, with the words that they have."""
    word = np.concatenate([x.word[x.first[d] : x.first[d + 1]] for d in docs])
    first = np.concatenate([[0], np.cumsum(x.first[docs + 1] - x.first[docs])])
    kept, word = np.unique(word, return_inverse=True)
    count = x.bag[kept + 1] - x.bag[kept]
    bag = np.concatenate([[0], np.cumsum(count)])
    rows = x.rows[np.repeat(x.bag[kept] - bag[:-1], count) + np.arange(bag[-1])]
    return Bags(word, first, rows, bag)


def _first_step(x: Bags, error: np.ndarray) -> np.ndarray:
    """AdaGrad's first pass over documents as bags of distinct words: sum over root of squares."""
    words = len(x.bag) - 1
    total, square = np.zeros(words), np.zeros(words)
    for docs in np.array_split(np.arange(len(error)), len(x.word) // (1 << 18) + 1):
        if len(docs):
            low, high = x.first[docs[0]], x.first[docs[-1] + 1]
            doc = np.repeat(docs, np.diff(x.first[docs[0] : docs[-1] + 2]))
            pairs = np.unique(doc * np.int64(words + 1) + x.word[low:high])
            doc, word = pairs // (words + 1), pairs % (words + 1)
            total += np.bincount(word, error[doc], words)
            square += np.bincount(word, error[doc] ** 2, words)
    up, squared = np.zeros(1 << BUCKET_BITS), np.zeros(1 << BUCKET_BITS)
    for some in np.array_split(np.arange(words), words // WORDS_AT_ONCE + 1):
        if len(some):
            low, high = some[0], some[-1] + 1
            rows, count = x.rows[x.bag[low] : x.bag[high]], np.diff(x.bag[low : high + 1])
            up += np.bincount(rows, np.repeat(total[low:high], count), len(up))
            squared += np.bincount(rows, np.repeat(square[low:high], count), len(up))
    return up / np.sqrt(squared + 1)


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic", rows_per_class: int = 2000) -> Model:
    """Learns `column` from at most `rows_per_class` labelled documents of either class.

    That bound is the sample of labelled rows which the model is fitted on; they are taken
    by hash of the doc_id. Rows whose crc32(doc_id as text) mod 4 is 2 are held out.
    """
    return train(*labelled_sample(docs, labels, column, rows_per_class))


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, rows_per_class: int) -> tuple[pa.Array, np.ndarray]:
    known = (
        labels.filter(f"doc_id is not null and {column} is not null")
        .filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
        .groupBy("doc_id")
        .agg(F.max(column).cast("int").alias("label"))
    )
    taken = common.sample_by_hash(known.filter("label = 1"), "doc_id", rows_per_class).unionByName(
        common.sample_by_hash(known.filter("label = 0"), "doc_id", rows_per_class)
    )
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(taken), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("text").alias("text"), F.max("label").alias("label"))
        .toPandas()
        .sort_values("doc_id")
    )
    return pa.array(rows["text"], pa.large_string()), rows["label"].to_numpy(float)


def scores(docs: DataFrame, model, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, by one pass over the texts.

    Null and empty texts are scored as texts without words; every row gives one row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @common.frugal
    def score(batches):
        for batch in batches:
            p = shared.value.probabilities(batch.column(1))
            yield pa.record_batch(
                [batch.column(0), pa.array(common.held_out(batch.column(0), 4)), pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"],
            )

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int")


def scores_of_texts(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, rows_per_class: int = 2000) -> DataFrame:
    """All rows and columns of `docs`, with score and predicted (columns of these names are replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, "toxic", rows_per_class))
    names = [c for c in docs.columns if c not in ("score", "predicted")]
    packed = docs.select("text", F.struct(*(F.col(f"`{c}`") for c in names)).alias("rest"))

    @common.frugal
    def score(batches):
        for batch in batches:
            p = shared.value.probabilities(batch.column(0))
            yield pa.record_batch([batch.column(1), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["rest", "score", "predicted"])

    made = T.StructType.fromDDL("score double, predicted int").fields
    out = packed.mapInArrow(score, T.StructType([packed.schema["rest"], *made]))
    return out.select(*(F.col(f"rest.`{c}`").alias(c) for c in names), "score", "predicted")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, rows_per_class: int = 2000) -> DataFrame:
    """Scores every whole text for toxicity; see `fit` and `scores`. Extra columns are ignored."""
    return scores(docs, fit(docs, labels, "toxic", rows_per_class), threshold)


def brute_force_score(model: Model, text: str | None) -> float:
    """One text word by word, for tests."""
    words = (text or "").encode().lower().split()
    per = []
    for w in words:
        wrapped = b"<" + w + b">"
        keys = [common.hash_slices(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0]]
        for n in GRAMS:
            for i in range(len(wrapped) - n + 1):
                keys.append(mix(np.array([int.from_bytes(wrapped[i : i + n], "little") ^ (n << 56)], np.uint64))[0])
        per.append(np.mean([model.weight[int(k) >> (64 - BUCKET_BITS)] for k in keys]))
    n = min(model.window, len(per))
    top = max((np.mean(per[i : i + n]) for i in range(len(per) - n + 1)), default=0.0) if n else 0.0
    return float(1 / (1 + np.exp(-(top + model.bias))))


def accuracy(scored: pd.DataFrame, label: pd.Series) -> float:
    return float(((scored["predicted"] == 1) == (label == 1)).mean())
