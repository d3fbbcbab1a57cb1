import hashlib
import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import common
from ledgerlens.llm import substring_dedup as sd
from odd_rows import no_docs, odd_docs, small


def outcome(df):
    return {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect()}


def test_automaton_gives_first_owners():
    draw = random.Random(3)
    for _ in range(60):
        sequences = [[draw.randint(0, 2) for _ in range(draw.randint(1, 30))] for _ in range(6)]
        automaton = sd.SuffixAutomaton()
        for owner, s in enumerate(sequences[:-1]):
            automaton.add(s, owner)
        query = sequences[-1]
        for end, owner in enumerate(automaton.first_owners(query, 4), 1):
            part = query[end - 4 : end]
            expect = next((o for o, s in enumerate(sequences[:-1]) if end >= 4 and any(s[i : i + 4] == part for i in range(len(s) - 3))), None)
            assert owner == expect


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_equals_all_windows(spark, folder):
    docs = small(spark, "documents", folder)
    assert outcome(sd.substring_dedup(docs)) == sd.brute_force(docs.toPandas())


@pytest.mark.parametrize("hot", [True, False])
def test_small_alphabet(spark, monkeypatch, hot):
    """Many repeats, copies and self-overlaps; hot anchors give the same."""
    if hot:
        monkeypatch.setattr(sd, "HOT_LEAST", 3)
    draw = random.Random(4)
    texts = [" ".join(draw.choices("ab", k=draw.randint(1, 60))) for _ in range(60)]
    passage = " ".join(f"p{i}" for i in range(30))
    texts += [f"{t} {passage} {u}" for t, u in zip(texts[:20], texts[20:], strict=False)] + texts[:5]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert outcome(sd.substring_dedup(docs)) == sd.brute_force(docs.toPandas())


def test_equals_all_windows_of_a_larger_table(spark):
    docs = small(spark, "documents", "/root/testdata/sf0.1")
    assert outcome(sd.substring_dedup(docs)) == sd.brute_force(docs.toPandas())


@pytest.mark.parametrize("hot", [True, False])
def test_blocks_repeated_in_one_document(spark, monkeypatch, hot):
    """Every place of a shared passage goes, also where its surroundings are repeated."""
    if hot:
        monkeypatch.setattr(sd, "HOT_LEAST", 0)
        monkeypatch.setattr(sd, "HOT_SHARE", 1 << 62)
    block = lambda name, n: " ".join(f"{name}{i}" for i in range(n))
    texts = [block("p", 13)]
    for d, size in enumerate((13, 14, 20, 30)):
        texts[0] += f" cut{d} " + block(f"p{d}x", size)
        own = f"{block(f'x{d}y', 20)} {block(f'p{d}x', size)} {block(f'z{d}y', 20)}"
        texts.append(f"{own} {own} between {own}")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = outcome(sd.substring_dedup(docs))
    assert got == sd.brute_force(docs.toPandas())
    assert [got[d][1] for d in range(5)] == [0, 39, 42, 60, 90]
    again = docs.unionByName(docs.filter("doc_id > 0").selectExpr("doc_id", "concat('other ', text, ' end') as text"))
    rows = sorted((r.doc_id, r.n_removed) for r in sd.substring_dedup(again).collect())
    assert rows == [(0, 0), (1, 39), (1, 39), (2, 42), (2, 42), (3, 60), (3, 60), (4, 90), (4, 90)]


def test_odd_rows(spark):
    docs = odd_docs(spark, with_clashes=True)
    out = sd.substring_dedup(docs)
    assert out.columns == [*docs.columns, "n_words", "n_removed", "kept"]
    rows = out.toPandas()
    assert len(rows) == 17
    named = rows[rows.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert named.loc[1, "n_removed"] == 0 and named.loc[2, "n_removed"] == 120 and named.loc[2, "kept"] == ""
    assert named.loc[3, "kept"] == "one more word here" and named.loc[13, "n_removed"] == 0
    assert named.loc[14, "n_removed"] == 40 and named.loc[10, "n_removed"] == 0
    assert (rows[rows.doc_id.isna()]["n_removed"] == 0).all() and named.loc[4, "kept"] == ""
    assert (rows["odd name"] == "z").all() and (rows["rest"] == 3).all()
    assert sd.substring_dedup(no_docs(spark)).count() == 0


def test_key_filter_takes_little_of_the_driver(spark):
    """The marks of many keys reach the driver as bytes; a row object for each takes many times as much."""
    keys = spark.range(0, 300_000, 1, 4).select((F.col("id") * 7919).alias("key"))
    common.key_filter(keys.limit(10), "key")
    tracemalloc.start()
    table = common.key_filter(keys, "key")
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    assert common.admitted(np.arange(300_000) * 7919, table).all()
    assert int(np.bitwise_count(table).sum()) <= 300_000
    assert not common.key_filter(keys.filter("key < 0"), "key").any()
