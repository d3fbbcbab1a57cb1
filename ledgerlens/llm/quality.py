"""Quality: a byte-level convolutional network in numpy, over whole documents.

Each byte has a learned embedding and one channel that tells whether the eight bytes from
here on repeat at a distance of at most 24 (text that repeats itself). Learned filters of
12 bytes move by 4; their outputs are max-pooled over chunks of 512 bytes that overlap by
half and together cover the document. Mean and maximum of the chunks' pooled values go into
one probability. All weights are trained jointly by Adam; the gradient of a pooled value
goes to the place that gave it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm.toxicity import labelled_sample, scores

STRIDE, TAPS, HALF = 4, 3, 256
CHANNELS, FILTERS, LAGS, SAME = 8, 32, 24, 8
PER_HALF = HALF // STRIDE


def repeats(x: np.ndarray) -> np.ndarray:
    """1 where the next eight bytes equal those at some distance of 1 to 24 before."""
    out = np.zeros(len(x), np.uint8)
    for lag in range(1, LAGS + 1):
        same = (x[lag:] == x[:-lag]) & (x[lag:] != 0)
        for step in (1, 2, 4):
            same = same[:-step] & same[step:] if len(same) > step else same[:0]
        out[lag : lag + len(same)] |= same
    return out


@dataclass
class Batch:
    """Texts laid out in halves of chunks, at least TAPS strides of zeros after each text."""

    data: np.ndarray
    repeated: np.ndarray
    first: np.ndarray  # of each text's halves

    @classmethod
    def of(cls, texts: list[bytes]) -> Batch:
        halves = [-(-(len(t) + TAPS * STRIDE) // HALF) for t in texts]
        data = b"".join(t.ljust(h * HALF, b"\0") for t, h in zip(texts, halves, strict=True))
        x = np.frombuffer(data + b"\0" * (TAPS * STRIDE), np.uint8)
        return cls(x, repeats(x), np.concatenate([[0], np.cumsum(halves)]))


@dataclass
class Network:
    embedding: np.ndarray  # 256 x (CHANNELS - 1)
    filters: np.ndarray  # TAPS x (STRIDE * CHANNELS) x FILTERS
    bias: np.ndarray
    out: np.ndarray  # of means, then of maxima
    shift: float

    def blocks(self, b: Batch) -> np.ndarray:
        x = np.empty((len(b.data), CHANNELS), np.float32)
        x[:, :-1] = self.embedding[b.data]
        x[:, -1] = b.repeated
        return x.reshape(-1, STRIDE * CHANNELS)

    def pooled(self, blocks: np.ndarray) -> np.ndarray:
        """Filter outputs by half, place in the half, filter."""
        n = len(blocks) - TAPS
        z = blocks[:n] @ self.filters[0]
        for k in range(1, TAPS):
            z += blocks[k : n + k] @ self.filters[k]
        return (z + self.bias).reshape(-1, PER_HALF, FILTERS)

    def document(self, top: np.ndarray, first: np.ndarray):
        """Chunk values of each text, which half gave each, and the texts' vectors."""
        chunk_first = np.concatenate([[0], np.cumsum(np.maximum(np.diff(first) - 1, 1))])
        at = np.concatenate([np.arange(a, max(b - 1, a + 1)) for a, b in zip(first[:-1], first[1:], strict=True)])
        end = np.repeat(first[1:], np.diff(chunk_first))
        after = np.minimum(at + 1, end - 1)
        second = top[after] > top[at]
        half = np.where(second, after[:, None], at[:, None])
        value = np.maximum(np.where(second, top[after], top[at]), 0)
        count = np.diff(chunk_first)[:, None]
        mean = np.add.reduceat(value, chunk_first[:-1]) / count
        most = np.maximum.reduceat(value, chunk_first[:-1])
        return chunk_first, half, value, np.concatenate([mean, most], 1)

    def logits(self, texts: list[bytes]) -> np.ndarray:
        b = Batch.of(texts)
        return self.document(self.pooled(self.blocks(b)).max(1), b.first)[3] @ self.out + self.shift

    def probabilities(self, column: pa.Array) -> np.ndarray:
        texts = [t.encode() for t in common.text_array(column).to_pylist()]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
        out = np.zeros(len(texts))
        for low, high in common.pieces(offsets, 1 << 19):
            for a in range(low, high, 1024):  # many empty texts are long when laid out
                out[a : min(a + 1024, high)] = self.logits(texts[a : min(a + 1024, high)])
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def train(texts: pa.Array, label: np.ndarray, prior: float, epochs: int = 8, rate: float = 0.005) -> Network:
    """Fits on a sample of labelled texts; `prior`: log odds of label 1 among all rows.

    Without both labels every text gets the prior's probability.
    """
    random = np.random.default_rng(3)
    net = Network(
        random.normal(0, 0.5, (256, CHANNELS - 1)).astype(np.float32),
        random.normal(0, 0.12, (TAPS, STRIDE * CHANNELS, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        random.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
        0.0,
    )
    label = np.asarray(label, float)
    if not 0 < label.sum() < len(label):
        net.out[:] = 0
        net.shift = prior
        return net
    texts = [t.encode() for t in common.text_array(texts).to_pylist()]
    weights = [net.embedding, net.filters, net.bias, net.out, np.zeros(1, np.float32)]
    first_moment, second_moment = ([np.zeros_like(w) for w in weights] for _ in range(2))
    weigh = np.where(label > 0, 0.5 / label.mean(), 0.5 / (1 - label.mean()))
    count = 0
    for epoch in range(epochs):
        for docs in np.array_split(random.permutation(len(label)), max(1, len(label) // 32)):
            slope = _slope(net, [texts[d] for d in docs], label[docs], weigh[docs], weights[4][0])
            count += 1
            now = rate * (1 - epoch / epochs)
            for w, g, m, v in zip(weights, slope, first_moment, second_moment, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w += now * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
    net.shift = float(weights[4][0]) + prior
    return net


def _slope(net: Network, texts: list[bytes], label: np.ndarray, weigh: np.ndarray, shift: float) -> list[np.ndarray]:
    """Gradient of the weighted log likelihood per document, for every weight."""
    b = Batch.of(texts)
    blocks = net.blocks(b)
    z = net.pooled(blocks)
    place = z.argmax(1)
    top = np.take_along_axis(z, place[:, None], 1)[:, 0]
    chunk_first, half, value, vector = net.document(top, b.first)
    logit = vector @ net.out + shift
    error = ((label - 1 / (1 + np.exp(-np.clip(logit, -50, 50)))) * weigh / len(texts)).astype(np.float32)
    size = np.diff(chunk_first)
    doc = np.repeat(np.arange(len(texts)), size)
    back = (error / size)[doc][:, None] * net.out[:FILTERS]
    best = (value == vector[doc, FILTERS:]) & (value > 0)
    shared = np.add.reduceat(best, chunk_first[:-1])[doc]
    back = back + np.where(best, error[doc][:, None] * net.out[FILTERS:] / np.maximum(shared, 1), 0)
    back[value <= 0] = 0
    chunk, which = np.nonzero(back)
    g = back[chunk, which].astype(np.float32)
    from_half = half[chunk, which]
    at = from_half * PER_HALF + place[from_half, which]
    patch = np.concatenate([blocks[at + k] for k in range(TAPS)], 1)
    d_filters = np.zeros((TAPS * STRIDE * CHANNELS, FILTERS), np.float32)
    for f in range(FILTERS):
        own = which == f
        d_filters[:, f] = g[own] @ patch[own]
    flat = net.filters.reshape(-1, FILTERS)
    d_patch = (g[:, None] * flat.T[which]).reshape(-1, CHANNELS)[:, :-1]
    bytes_at = b.data[(at[:, None] * STRIDE + np.arange(TAPS * STRIDE))].reshape(-1)
    d_embedding = np.stack([np.bincount(bytes_at, d_patch[:, c], 256) for c in range(CHANNELS - 1)], 1).astype(np.float32)
    return [
        d_embedding,
        d_filters.reshape(net.filters.shape),
        np.bincount(which, g, FILTERS).astype(np.float32),
        error @ vector,
        np.array([error.sum()], np.float32),
    ]


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", rows_per_class: int = 1500) -> Network:
    """Learns `column` from at most `rows_per_class` labelled documents of either class.

    Only rows whose crc32(doc_id as text) mod 4 is not 2; the prior counts all of those.
    """
    counts = dict(
        labels.filter(f"doc_id is not null and {column} is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
        .groupBy(F.col(column).cast("int"))
        .count()
        .collect()
    )
    prior = float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
    return train(*labelled_sample(docs, labels, column, rows_per_class), prior)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, rows_per_class: int = 1500) -> DataFrame:
    """doc_id, held_out, score, predicted of every row, from its whole text.

    Null and empty texts are scored as texts without bytes. Other columns are ignored.
    """
    return scores(docs, fit(docs, labels, "quality", rows_per_class), threshold)
