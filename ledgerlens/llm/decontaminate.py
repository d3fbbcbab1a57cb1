"""Benchmark items in documents, with up to a share of edits, by pieces and Myers' distance.

Texts are lower-cased and runs of white space become one space. An item of length n may be
met with k = floor(rate * n) edits. It is cut into k + 1 pieces; k edits leave one piece at
least unharmed, so every occurrence has an exact piece at about its place (pigeonhole). An
Aho-Corasick automaton finds the pieces of many items in one pass over a text, and Myers'
bit-parallel algorithm gives the least edit distance of the item around each hit.

Items are broadcast in blocks of bounded size, one pass over the documents per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import common

BLOCK_CHARS = 4 << 20
HIT = "struct<item_id:bigint,distance:int,begin:int,end:int>"
HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())]))


def normalized(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece): errors + 1 pieces of almost equal length; no more than characters."""
    n = min(errors + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def myers(pattern: str, text: str, free_start: bool = True) -> list[int]:
    """Least distance of the pattern to a part of the text ending at each of its places.

    Without `free_start` the parts begin where the text begins.
    """
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, score, out = full, 0, len(pattern), []
    for c in text:
        eq = masks.get(c, 0)
        diagonal = (((eq & plus) + plus) ^ plus) | eq | minus
        up, down = minus | (full & ~(diagonal | plus)), plus & diagonal
        score += bool(up & top) - bool(down & top)
        up = up << 1 if free_start else up << 1 | 1
        plus, minus = (down << 1) & full | (full & ~((eq | minus) | up)), up & (eq | minus) & full
        out.append(score)
    return out


def best_match(item: str, text: str, at: int, errors: int) -> tuple[int, int, int] | None:
    """(distance, begin, end) of the item near place `at`, within the errors; or None."""
    if at >= 0 and text.startswith(item, at):
        return 0, at, at + len(item)
    low = max(0, at - errors)
    part = text[low : at + len(item) + errors]
    scores = myers(item, part)
    if not scores or min(scores) > errors:
        return None
    distance = min(scores)
    end = scores.index(distance) + 1
    back = myers(item[::-1], part[:end][::-1], free_start=False)
    return distance, low + end - (back.index(distance) + 1), low + end


class Finder:
    """Finds a block of items, (item_id, normalized text) each."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.items = [(i, t, int(rate * len(t))) for i, t in items if t]
        places: dict[str, list[tuple[int, int]]] = {}
        for k, (_, text, errors) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                places.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, int, int]]:
        """The best occurrence of each item that the text has."""
        best: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        text = normalized(text)
        for last, (size, where) in self.automaton.iter(text) if self.items else ():
            for k, offset in where:
                at = last + 1 - size - offset
                if (k, at) in tried or best.get(k, (1,))[0] == 0:
                    continue
                tried.add((k, at))
                item_id, item, errors = self.items[k]
                found = best_match(item, text, at, errors)
                if found and (k not in best or found < best[k]):
                    best[k] = found
        return [(self.items[k][0], *best[k]) for k in sorted(best)]


def item_blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """Distinct items in blocks of about `limit` characters, fetched a partition at a time."""
    block, size = [], 0
    for item_id, text in benchmark.select("item_id", "text").distinct().toLocalIterator():
        block.append((item_id, normalized(text)))
        size += len(block[-1][1])
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, rate: float = 0.05) -> DataFrame:
    """All rows and columns of `docs`, with `hits`: item_id, distance, begin, end of each item.

    Places count characters of the normalized text. Null or empty items match nothing, a
    null text has no hits, and a null doc_id or item_id is carried through. A column named
    hits is replaced. Of an item that occurs several times, the best occurrence is given.
    """
    spark = docs.sparkSession
    others = [c for c in docs.columns if c not in ("text", "hits")]
    out = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("rest"), "text")
    out = out.withColumn("hits", F.expr(f"cast(array() as array<{HIT}>)"))
    for block in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(block)

        def find(batches, shared=shared):
            finder = Finder(shared.value, rate)
            for batch in batches:
                texts = common.text_array(batch.column(1)).to_pylist()
                before = batch.column(2).to_pylist()
                hits = [
                    h + [dict(zip(("item_id", "distance", "begin", "end"), x, strict=True)) for x in finder.hits(t)]
                    for h, t in zip(before, texts, strict=True)
                ]
                yield pa.record_batch([batch.column(0), batch.column(1), pa.array(hits, HITS)], ["rest", "text", "hits"])

        out = out.mapInArrow(find, out.schema)
    return out.select(*(F.col("text") if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns if c != "hits"), "hits")


def edit_distance_within(pattern: str, text: str) -> int:
    """Least edit distance of the pattern to any part of the text, by the full table, for tests."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        above, row = row, [i]
        for j, t in enumerate(text, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (p != t)))
    return min(row)
