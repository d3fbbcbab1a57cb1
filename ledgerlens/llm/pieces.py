"""SentencePiece encoding and decoding by batched numpy Viterbi.

A text is a space mark, the text with spaces written as marks, cut before each run of marks
and around characters that no piece has; no piece reaches over such a cut. Distinct words
of equal length advance together, one character a step: hashes of the substrings that end
there probe the sorted hashes of all pieces, and the vectorised maximum of score so far
plus piece score leaves a back pointer. Characters without a piece become byte pieces.

Ids are the path of the greatest score sum under the model's piece scores. For a model of
merges that is not the library's greedy order of merges (see the README); decoding
restores every text exactly.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm import common
from ledgerlens.llm.common import IdCache, hash_slices, mix, ranges

MARK = 0x2581
LITERAL_MARK = 0x110000  # the mark character in a text itself; no piece has it
POINTS = LITERAL_MARK + 1
BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class PieceTable:
    """What encoding needs of a model; some megabytes, whatever the texts are."""

    keys: np.ndarray
    ids: np.ndarray
    scores: np.ndarray
    longest: int
    alphabet: np.ndarray
    byte_ids: np.ndarray
    piece_bytes: list[bytes]

    @classmethod
    def load(cls, model_file: str) -> PieceTable:
        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        byte_ids = np.zeros(256, np.uint32)
        texts, ids, shown = [], [], []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                shown.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                shown.append(b"")
            else:
                texts.append(piece)
                ids.append(i)
                shown.append(piece.replace(chr(MARK), " ").encode())
        keys = np.array([point_hash(np.array([[ord(c) for c in t]]))[0] for t in texts], np.uint64)
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two pieces have one hash")
        order = np.argsort(keys)
        alphabet = np.zeros(POINTS, bool)
        alphabet[[ord(c) for t in texts for c in t]] = True
        scores = np.array([sp.get_score(i) for i in ids])
        return cls(keys[order], np.array(ids, np.uint32)[order], scores[order], max(map(len, texts)), alphabet, byte_ids, shown)


def point_hash(points: np.ndarray) -> np.ndarray:
    """Polynomial hash of each row of code points, by the same rule as the running sums."""
    h = np.zeros(len(points), np.uint64)
    for j in range(points.shape[1]):
        h = h * BASE + mix(points[:, j].astype(np.uint64) + BASE)
    return h


def viterbi(words: np.ndarray, table: PieceTable) -> list[np.ndarray]:
    """Ids of words of one length, a row of code points each."""
    n, length = words.shape
    total = np.zeros((length + 1, n), np.uint64)
    best = np.full((length + 1, n), -np.inf)
    step, piece = np.zeros((length + 1, n), np.int32), np.full((length + 1, n), -1, np.int64)
    best[0] = 0
    unknown = table.scores.min() - 10
    power = [np.uint64(1)]
    with np.errstate(over="ignore"):
        for _ in range(table.longest):
            power.append(power[-1] * BASE)
        for e in range(1, length + 1):
            total[e] = total[e - 1] * BASE + mix(words[:, e - 1].astype(np.uint64) + BASE)
            best[e], step[e] = best[e - 1] + unknown, 1
            for size in range(1, min(e, table.longest) + 1):
                key = total[e] - total[e - size] * power[size]
                at = np.minimum(np.searchsorted(table.keys, key), len(table.keys) - 1)
                score = np.where(table.keys[at] == key, best[e - size] + table.scores[at], -np.inf)
                better = score > best[e]
                best[e][better], step[e][better], piece[e][better] = score[better], size, at[better]
    place = np.full(n, length)
    rows, ends, found = [], [], []
    while len(active := np.flatnonzero(place > 0)):
        at = place[active]
        rows.append(active)
        ends.append(at)
        found.append(piece[at, active])
        place[active] = at - step[at, active]
    rows, ends, found = (np.concatenate(x) for x in (rows, ends, found))
    order = np.lexsort((ends, rows))
    rows, ends, found = rows[order], ends[order], found[order]
    count = np.bincount(rows, minlength=n)
    ids = table.ids[np.maximum(found, 0)]
    if (found >= 0).all():
        return np.split(ids, np.cumsum(count)[:-1])
    parts = [
        ids[i : i + 1] if found[i] >= 0 else _byte_ids(int(words[rows[i], ends[i] - 1]), table) for i in range(len(rows))
    ]
    cuts = np.cumsum(count)
    return [np.concatenate(parts[b - c : b]) for b, c in zip(cuts, count, strict=True)]


def _byte_ids(point: int, table: PieceTable) -> np.ndarray:
    return table.byte_ids[list(chr(MARK if point == LITERAL_MARK else point).encode())]


class PieceEncoder:
    """Encodes batches of texts; every distinct word of a process once."""

    def __init__(self, table: PieceTable):
        self.table, self.cache = table, IdCache()

    def _new(self, points: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out: list = [None] * len(start)
        for size in np.unique(length):
            same = np.flatnonzero(length == size)
            for some in np.array_split(same, max(1, len(same) * int(size) // (1 << 18))):
                words = points[start[some][:, None] + np.arange(size)]
                for i, ids in zip(some, viterbi(words, self.table), strict=True):
                    out[i] = ids
        return np.concatenate(out), np.array([len(ids) for ids in out], np.int64)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        size = np.array([len(t) + bool(t) for t in texts], np.int64)
        first = np.concatenate([[0], np.cumsum(size)])
        joined = "".join(" " + t if t else "" for t in texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32).copy()
        points[points == MARK] = LITERAL_MARK
        points[points == 32] = MARK
        mark, known = points == MARK, self.table.alphabet[points]
        begin = np.ones(len(points), bool)
        begin[1:] = (mark[1:] & ~mark[:-1]) | ~known[1:] | ~known[:-1]
        begin[first[:-1][size > 0]] = True
        start = np.flatnonzero(begin)
        length = np.diff(np.append(start, len(points)))
        hashes = hash_slices(points.view(np.uint8), start * 4, length * 4)
        ids, count = self.cache.look_up(hashes, lambda at: self._new(points, start[at], length[at]))
        return ids, np.concatenate([[0], np.cumsum(count)])[np.searchsorted(start, first)]


class PieceDecoder:
    def __init__(self, table: PieceTable):
        size = np.array([len(b) for b in table.piece_bytes], np.int64)
        self.size, self.begin = size, np.cumsum(size) - size
        self.data = np.frombuffer(b"".join(table.piece_bytes), np.uint8)

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[str]:
        """Texts of the ids `ids[first[d]:first[d + 1]]`, without the leading space."""
        count = self.size[ids]
        data = self.data[ranges(self.begin[ids], count)].tobytes()
        at = np.concatenate([[0], np.cumsum(count)])[first]
        return [data[a:b].decode("utf-8", "replace")[1:] for a, b in zip(at, at[1:], strict=False)]


def encode_pieces(docs: DataFrame, model_file: str, checksum: bool = False) -> DataFrame:
    """All rows and columns of `docs`, with token_ids: array of int. Null and empty: no ids.

    With `checksum` there is ids_crc32, too: crc32 of the ids as little-endian unsigned
    32-bit numbers. Columns of these names are replaced.
    """
    made = "token_ids array<int>" + ", ids_crc32 long" * checksum
    new = ["token_ids", "ids_crc32"][: 1 + checksum]
    shared = docs.sparkSession.sparkContext.broadcast(PieceTable.load(model_file))
    others = [c for c in docs.columns if c not in ("text", *new)]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("rest"), "text")

    @common.frugal
    def encode(batches):
        encoder = PieceEncoder(shared.value)
        for batch in batches:
            texts = common.text_array(batch.column(1)).to_pylist()
            parts, sums = [], []
            sizes = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for low, high in common.pieces(sizes, 1 << 20):
                ids, first = encoder.encode(texts[low:high])
                parts.append(pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids.astype(np.int32))))
                if checksum:
                    octets = memoryview(ids.astype("<u4").tobytes())
                    sums += [zlib.crc32(octets[4 * a : 4 * b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            ids = pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))
            columns = [batch.column(0), batch.column(1), ids, pa.array(sums, pa.int64())]
            yield pa.record_batch(columns[: 2 + len(new)], ["rest", "text", *new])

    out = packed.mapInArrow(encode, T.StructType([*packed.schema.fields, *T.StructType.fromDDL(made).fields]))
    return out.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c not in new), *new)


def decode_pieces(tokens: DataFrame, model_file: str) -> DataFrame:
    """All rows and columns of `tokens`, with decoded: the text of token_ids (null: empty)."""
    shared = tokens.sparkSession.sparkContext.broadcast(PieceTable.load(model_file))
    others = [c for c in tokens.columns if c not in ("token_ids", "decoded")]
    packed = tokens.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("rest"), "token_ids")

    @common.frugal
    def decode(batches):
        decoder = PieceDecoder(shared.value)
        for batch in batches:
            lists = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            first = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(decoder.decode(flat, first), pa.string())],
                ["rest", "token_ids", "decoded"],
            )

    out = packed.mapInArrow(decode, T.StructType([*packed.schema.fields, *T.StructType.fromDDL("decoded string").fields]))
    return out.select(
        *(F.col(c) if c == "token_ids" else F.col(f"rest.`{c}`").alias(c) for c in tokens.columns if c != "decoded"), "decoded"
    )


def viterbi_plain(text: str, model_file: str) -> float:
    """Greatest score sum of a text without byte pieces, by a plain table, for tests."""
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    score = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
    text = chr(MARK) + text.replace(" ", chr(MARK))
    best = [0.0] + [-1e18] * len(text)
    for e in range(1, len(text) + 1):
        for b in range(max(0, e - 64), e):
            if text[b:e] in score:
                best[e] = max(best[e], best[b] + score[text[b:e]])
    return best[-1]


def crc32_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
