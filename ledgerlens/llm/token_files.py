"""Token ids as binary segments with a shared zstandard dictionary.

A token folder has two parquet tables, committed by Spark's own writers, so that a lost or
repeated task leaves nothing behind: `dictionary` (one row: hash, width of an id, bytes)
and `segments` (part, seq, first_id, last_id, n_docs, n_tokens, segment). Segments are in
ascending order of doc_id over (part, seq). A segment is

    magic "TIDS", width u16, version u16, dictionary hash u64, documents u64
    doc ids i64[n], id present u8[n], token counts u64[n], frame offsets u64[n + 1]
    frames: one zstandard frame per document, its ids in little-endian numbers of `width`

so one document is found by its index entry and read by decompressing its frame alone.
"""

from __future__ import annotations

import json
import os
import string
import struct
import zlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import common
from ledgerlens.llm.common import split_words, text_bytes

MAGIC, VERSION, HEADER = b"TIDS", 1, struct.Struct("<4sHHQQ")
SEGMENT_BYTES = 1 << 20
#: New words are encoded so many to a text.
WORDS_AT_ONCE = 512
#: A document's ids are samples of so many bytes for the dictionary.
SAMPLE_BYTES = 1 << 16
MARKS = "".join(c for c in string.punctuation if c not in "'<>|")
MARK, ALNUM = (np.array([chr(b) in chars for b in range(256)]) for chars in (MARKS, string.ascii_letters + string.digits))
SEGMENT_COLUMNS = "part int, seq int, first_id long, last_id long, n_docs long, n_tokens long, segment binary"


class WordEncoder:
    """Encodes whole texts; every distinct word once.

    No token spans ASCII space, the tokenizer lower-cases, and it cuts before a run of
    marks that follows a letter or digit; so ASCII case is folded and such runs count as
    words of their own. Words with a "<" may hold a special token, which depends on case,
    and are left as they are. Words are encoded many to a text: those of letters alone with
    spaces between them, for the last token of each is marked as the end of a word; others
    with a special token between them, which takes about twice the time.
    """

    def __init__(self, definition: str, separator: str, separator_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.between = np.frombuffer(f" {separator} ".encode(), np.uint8)
        self.separator_id = separator_id
        self.ends = _word_ends(json.loads(definition))
        self.cache = common.IdCache()

    def _encode(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the given words, and how many each has."""
        found = []  # (words, ids, counts)
        for low in range(0, len(start), WORDS_AT_ONCE):
            part = np.arange(low, min(low + WORDS_AT_ONCE, len(start)))
            text = _joined(data, start[part], length[part])
            words = text.split(" ")
            simple = np.array([w.isalpha() for w in text.lower().split(" ")], bool)
            if self.ends is None or not simple.any():
                simple[:] = False
            else:
                ids = self._ids(" ".join(w for w, s in zip(words, simple.tolist(), strict=True) if s))
                cuts = np.flatnonzero(self.ends[ids])
                if len(cuts) == simple.sum():  # each has one end at least, so one exactly
                    found.append((part[simple], ids, np.diff(cuts, prepend=-1)))
                else:  # a letter of Python's tables is none of the tokenizer's
                    simple[:] = False
            if not simple.all():
                rest = part[~simple]
                found.append((rest, *self._separated(data, start[rest], length[rest])))
        if not found:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        word, ids, count = (np.concatenate(x) for x in zip(*found, strict=True))
        begin = np.cumsum(count) - count
        order = np.argsort(word)
        return ids[common.ranges(begin[order], count[order])], count[order]

    def _separated(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for any words."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for low in range(0, len(start), WORDS_AT_ONCE):
            begin, size = start[low : low + WORDS_AT_ONCE], length[low : low + WORDS_AT_ONCE]
            step = size + len(self.between)
            joined = np.empty(step.sum(), np.uint8)
            at = np.cumsum(step) - step
            joined[common.ranges(at, size)] = data[common.ranges(begin, size)]
            joined[((at + size)[:, None] + np.arange(len(self.between))).ravel()] = np.tile(self.between, len(size))
            got = self._ids(joined.tobytes().decode())
            cuts = np.flatnonzero(got == self.separator_id)
            if len(cuts) == len(size):
                ids.append(np.delete(got, cuts))
                counts.append(np.diff(np.concatenate([[-1], cuts])) - 1)
            else:  # a word has the special token itself
                each = [self._ids(data[b : b + n].tobytes().decode()) for b, n in zip(begin, size, strict=True)]
                ids += each
                counts.append(np.array([len(x) for x in each], np.int64))
        return np.concatenate(ids), np.concatenate(counts)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each text's ids begin."""
        whole, offsets = text_bytes(texts)
        ids, first = [np.zeros(0, np.uint32)], [np.zeros(1, np.int64)]
        for low, high in common.pieces(offsets):
            words = split_words(whole[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
            data, start, length, begin = _units(words)
            part, count = self.cache.look_up(
                common.hash_slices(data, start, length),
                lambda at, d=data, s=start, n=length: self._encode(d, s[at], n[at]),
            )
            ids.append(part)
            first.append(first[-1][-1] + np.concatenate([[0], np.cumsum(count)])[begin[1:]])
        return np.concatenate(ids), np.concatenate(first)


def _joined(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> str:
    """The given words with a space between them."""
    at = np.cumsum(length + 1) - length - 1
    joined = np.full(at[-1] + length[-1], ord(" "), np.uint8)
    joined[common.ranges(at, length)] = data[common.ranges(start, length)]
    return joined.tobytes().decode()


def _word_ends(definition: dict) -> np.ndarray | None:
    """Which ids end a word of the tokenizer; None if that can't tell words of letters apart.

    It can if every piece of text ends in exactly one such id: the end of a word is marked
    by a suffix, every character has an id with it, and no special token is made of letters.
    """
    model = definition["model"]
    suffix, vocabulary = model.get("end_of_word_suffix"), model.get("vocab")
    added = definition.get("added_tokens") or []
    if not suffix or not isinstance(vocabulary, dict) or any(t["content"].isalpha() for t in added):
        return None
    if any(len(c) == 1 and c + suffix not in vocabulary for c in vocabulary):
        return None
    ends = np.zeros(max([*vocabulary.values(), *(t["id"] for t in added)]) + 1, bool)
    ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
    return ends


def _units(words: common.Words) -> tuple[np.ndarray, ...]:
    """Words with ASCII case folded and their trailing marks apart."""
    data = common.LOWER[words.data]
    marked = np.flatnonzero(words.data == ord("<"))
    special = np.unique(np.searchsorted(words.start, marked, "right") - 1)
    for i in special:
        part = slice(words.start[i], words.start[i] + words.length[i])
        data[part] = words.data[part]
    tail = np.zeros(len(words.start), np.int64)
    going = np.arange(len(tail))
    while len(going):
        last = words.start[going] + words.length[going] - 1 - tail[going]
        going = going[(words.length[going] - tail[going] > 1) & MARK[data[last]]]
        tail[going] += 1
    before = data[words.start + words.length - 1 - tail] if len(tail) else data[:0]
    tail[~ALNUM[before]] = 0
    has = np.flatnonzero(tail)
    place = np.arange(len(tail)) + np.cumsum(tail > 0) - (tail > 0)
    start, length = (np.empty(len(tail) + len(has), np.int64) for _ in range(2))
    start[place], length[place] = words.start, words.length - tail
    start[place[has] + 1], length[place[has] + 1] = (words.start + words.length - tail)[has], tail[has]
    return data, start, length, words.first + np.concatenate([[0], np.cumsum(tail > 0)])[words.first]


def train_dictionary(samples: list[bytes], size: int) -> bytes:
    """A zstandard dictionary; empty if the samples are too few or too short for one."""
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _shared(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if data else None


def dictionary_hash(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data)


def pack(width: int, hashed: int, docs: list[tuple[int | None, int, bytes]]) -> bytes:
    """A segment of (doc_id, token count, frame)."""
    ids = np.array([d or 0 for d, _, _ in docs], "<i8")
    there = np.array([d is not None for d, _, _ in docs], np.uint8)
    counts = np.array([n for _, n, _ in docs], "<u8")
    offsets = np.cumsum([0, *(len(f) for _, _, f in docs)]).astype("<u8")
    head = HEADER.pack(MAGIC, width, VERSION, hashed, len(docs))
    return b"".join([head, ids.tobytes(), there.tobytes(), counts.tobytes(), offsets.tobytes(), *(f for _, _, f in docs)])


class Segment:
    """Reads a segment: its index at once, a document's ids on demand."""

    def __init__(self, data: bytes, dictionary: bytes):
        magic, self.width, version, hashed, n = HEADER.unpack_from(data)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a token segment of this version")
        if hashed != dictionary_hash(dictionary):
            raise ValueError("the segment was written with another dictionary")
        at = HEADER.size
        self.doc_id = np.frombuffer(data, "<i8", n, at)
        self.present = np.frombuffer(data, np.uint8, n, at + 8 * n).astype(bool)
        self.count = np.frombuffer(data, "<u8", n, at + 9 * n).astype(np.int64)
        self.offset = np.frombuffer(data, "<u8", n + 1, at + 17 * n).astype(np.int64)
        self.data, self.frames = data, at + 25 * n + 8
        self.inflate = zstandard.ZstdDecompressor(dict_data=_shared(dictionary))

    def ids(self, i: int) -> np.ndarray:
        frame = self.data[self.frames + self.offset[i] : self.frames + self.offset[i + 1]]
        return np.frombuffer(self.inflate.decompress(frame), f"<u{self.width}").astype("<u4")


def write_tokens(
    docs: DataFrame,
    tokenizer_file: str,
    folder: str,
    end_id: int = 1,
    separator: str = "<|endoftext|>",
    sample_docs: int = 1000,
    dictionary_bytes: int = 64 << 10,
) -> None:
    """Encodes every whole text (null: empty), appends `end_id`, writes the token folder.

    Rows are ordered by doc_id (missing ids first; equal ids by their frames, so repeated
    rows are all kept in a defined order). The dictionary is trained on all ids of
    `sample_docs` documents taken by hash of the id; the driver holds these.
    """
    spark = docs.sparkSession
    with open(tokenizer_file) as f:
        definition = f.read()
    vocabulary = Tokenizer.from_str(definition)
    width = 2 if max(vocabulary.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
    plan = spark.sparkContext.broadcast((definition, separator, vocabulary.token_to_id(separator)))
    base = docs.select("doc_id", "text")

    @common.frugal
    def raw(batches):
        encoder = _encoder(plan.value)
        for batch in batches:
            ids, first = encoder.encode(batch.column(0))
            whole = (ids[a:b].astype(f"<u{width}").tobytes() for a, b in zip(first, first[1:]))
            parts = [x[at : at + SAMPLE_BYTES] for x in whole for at in range(0, len(x), SAMPLE_BYTES)]
            yield pa.record_batch([pa.array(parts, pa.binary())], ["ids"])

    # Ids first, so that no texts but those of the sample are moved.
    taken = common.sample_by_hash(base.select("doc_id").filter("doc_id is not null").distinct(), "doc_id", sample_docs)
    sample = base.join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text")).select("text")
    dictionary = train_dictionary([bytes(r[0]) for r in sample.mapInArrow(raw, "ids binary").collect() if r[0]], dictionary_bytes)
    hashed = dictionary_hash(dictionary)
    shared = spark.sparkContext.broadcast(dictionary)
    spark.createDataFrame(
        [(hashed - (1 << 64) if hashed >= 1 << 63 else hashed, width, bytearray(dictionary))],
        "hash long, width int, bytes binary",
    ).coalesce(1).write.parquet(f"{folder}/dictionary")

    @common.frugal
    def frames(batches):
        encoder = _encoder(plan.value)
        deflate = zstandard.ZstdCompressor(level=3, dict_data=_shared(shared.value))
        for batch in batches:
            ids, first = encoder.encode(batch.column(1))
            ended = [np.append(ids[a:b], end_id).astype(f"<u{width}").tobytes() for a, b in zip(first, first[1:])]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(np.diff(first) + 1, pa.int64()),
                    pa.array([deflate.compress(x) for x in ended], pa.binary()),
                ],
                ["doc_id", "n_tokens", "frame"],
            )

    @common.frugal
    def segments(batches):
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row():
            known = [d for d, _, _ in held if d is not None]
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "first_id": pa.array([known[0] if known else None], pa.int64()),
                    "last_id": pa.array([known[-1] if known else None], pa.int64()),
                    "n_docs": pa.array([len(held)], pa.int64()),
                    "n_tokens": pa.array([sum(n for _, n, _ in held)], pa.int64()),
                    "segment": pa.array([pack(width, hashed, held)], pa.binary()),
                }
            )

        for batch in batches:
            for d, n, f in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append((d, n, f))
                size += len(f) + 32
                if size >= SEGMENT_BYTES:
                    yield row()
                    seq, held, size = seq + 1, [], 0
        if held:
            yield row()

    # The texts are dealt out, not the frames: the job that samples ids for the ranges
    # would run the encoder over everything first.
    ordered = (
        base.repartitionByRange("doc_id")
        .mapInArrow(frames, "doc_id long, n_tokens long, frame binary")
        .sortWithinPartitions("doc_id", "frame")
    )
    ordered.mapInArrow(segments, SEGMENT_COLUMNS).write.parquet(f"{folder}/segments")


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(plan: tuple) -> WordEncoder:
    """One encoder, with its cache, per Python worker and tokenizer."""
    key = hash(plan)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(*plan)
    return _ENCODERS[key]


def _dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").first()["bytes"])


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the folder's files.

    `start` counts the ids before a document: those of earlier parts (one row per part),
    of earlier segments of its part, and of earlier documents of its segment.
    """
    shared = spark.sparkContext.broadcast(_dictionary(spark, folder))
    segments = spark.read.parquet(f"{folder}/segments")
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_tokens")
    starts = segments.select("part", "seq", "n_tokens").withColumn("inside", inside)
    starts = starts.join(F.broadcast(before), "part").select("part", "seq", (F.col("before") + F.col("inside")).alias("start"))

    @common.frugal
    def rows(batches):
        for batch in batches:
            for start, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                s = Segment(data, shared.value)
                begin = start + np.concatenate([[0], np.cumsum(s.count)])[:-1]
                yield pa.record_batch(
                    {
                        "doc_id": pa.array(s.doc_id, mask=~s.present),
                        "start": pa.array(begin, pa.int64()),
                        "n_tokens": pa.array(s.count, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(s.ids(i).tobytes()) for i in range(len(s.count))], pa.int64()),
                    }
                )

    placed = segments.select("part", "seq", "segment").join(starts, ["part", "seq"]).select("start", "segment")
    return placed.mapInArrow(rows, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_ids(spark: SparkSession, folder: str, doc_id: int) -> list[list[int]]:
    """The ids of one document (a list per row of that id), reading only its segments."""
    dictionary = _dictionary(spark, folder)
    held = spark.read.parquet(f"{folder}/segments").filter(F.lit(doc_id).between(F.col("first_id"), F.col("last_id")))
    out = []
    for row in held.orderBy("part", "seq").select("segment").toLocalIterator():
        s = Segment(bytes(row[0]), dictionary)
        out += [s.ids(i).tolist() for i in np.flatnonzero(s.present & (s.doc_id == doc_id))]
    return out
