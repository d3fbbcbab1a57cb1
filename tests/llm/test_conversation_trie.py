import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import conversation_trie as trie
from odd_rows import small

CONV = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_force(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    members, children = defaultdict(list), defaultdict(set)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[rebuilt[c][:d]].append(c)
            if d:
                children[rebuilt[c][: d - 1]].add(rebuilt[c][:d])

    def below(v):
        saved = (len(members[v]) - 1) * (len(v[-1][1].encode()) if v else 0)
        leaves = int(not children[v])
        for u in children[v]:
            s, n = below(u)
            saved, leaves = saved + s, leaves + n
        return saved, leaves

    out = []
    for v in list(members):
        saved, leaves = below(v)
        ends = ",".join(str(c) for c in members[v] if len(rebuilt[c]) == len(v))
        out.append(
            (
                members[v][0], len(v), members[v[:-1]][0] if v else None, len(members[v]), len(children[v]), leaves, saved,
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def got(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def odd_rows():
    draw, rows = random.Random(5), []
    for c in range(60):
        for t in range(draw.choice([1, 2, 3, 7, 12])):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["hi", "hü", "", "ok then"])))
    rows += [(5, None, None, None), (5, None, "user", None), (6, 0, "user", "hi"), (6, 0, "user", "hi"), (None, 1, "user", "x")]
    rows += [(1002, 0, "user", "no base"), (1005, 3, None, None), (7, 2, "a", "x" * 70_000)]
    rows += [(2000, t // 3, "user", f"line {t % 4}") for t in range(40)] + [(2001, t, "user", "hi") for t in range(40)]
    draw.shuffle(rows)
    return rows


@pytest.fixture
def odd(spark):
    made = [(*r, 1, "n") for r in odd_rows()]
    return spark.createDataFrame(made, f"{CONV}, depth int, part string")


def test_odd_rows(spark, odd):
    assert got(trie.prefix_trie(odd)) == brute_force(odd_rows())
    assert got(trie.prefix_trie(odd.limit(0))) == []


def test_conversations_across_tasks_and_blocks(spark, odd, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK", 3)
    monkeypatch.setattr(trie, "IDS_IN_PIECE", 2)
    monkeypatch.setattr(trie, "SMALL_POWERS", 2)
    many = type(odd).repartitionByRange
    monkeypatch.setattr(type(odd), "repartitionByRange", lambda self, *c: many(self, 40, *c))
    assert got(trie.prefix_trie(odd)) == brute_force(odd_rows())


def test_shared_turn_numbers_are_noticed(odd, monkeypatch):
    strong = trie.turn_numbers
    weak = [F.lit(1).cast("long").alias("t1"), F.length("text").cast("long").alias("t2")]
    monkeypatch.setattr(trie, "turn_numbers", lambda seed: weak if seed == trie.ATTEMPTS[0][0] else strong(seed))
    assert got(trie.prefix_trie(odd)) == brute_force(odd_rows())


def test_shared_fingerprints_are_noticed(odd, monkeypatch):
    seed = trie.ATTEMPTS[0][0]
    monkeypatch.setattr(trie, "ATTEMPTS", ((seed, 0, 0), *trie.ATTEMPTS[1:]))
    assert got(trie.prefix_trie(odd)) == brute_force(odd_rows())
    monkeypatch.setattr(trie, "ATTEMPTS", ((seed, 0, 0),))
    with pytest.raises(RuntimeError):
        trie.prefix_trie(odd)


def test_table(spark):
    table = small(spark, "conversations", "/root/testdata/sf0.01")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert got(trie.prefix_trie(table)) == brute_force(rows)
