import os
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import ngram_join as nj
from odd_rows import no_docs, odd_docs, small


@pytest.mark.parametrize("shingle", [4, 5])
def test_equals_all_pairs(spark, shingle):
    docs = small(spark, "documents")
    got = {r.doc_id: r.component_id for r in nj.jaccard_components(docs, shingle, 60, 100).collect()}
    assert got == nj.brute_force(docs.toPandas(), shingle, 60, 100)


@pytest.mark.parametrize("rounds", [False, True])
def test_near_copies_of_one_text(spark, monkeypatch, rounds):
    """Chains of edits: neighbours are linked, the ends are not. Also with every key in
    several blocks and in rounds of nearest pairs."""
    if rounds:
        for name, value in (("SMALL_GROUP", 1), ("BLOCK", 8), ("ROWS_AT_ONCE", 64), ("BYTES_AT_ONCE", 500)):
            monkeypatch.setattr(nj, name, value)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for k in range(30):
        for j in range(k):
            words[6 * j] = f"edit{j}"
        rows.append((k, " ".join(words), "", "", 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.component_id for r in nj.jaccard_components(docs).collect()}
    assert got == nj.brute_force(docs.toPandas())


def test_odd_rows(spark):
    out = nj.jaccard_components(odd_docs(spark, with_clashes=True)).toPandas()
    assert len(out) == 17
    named = out[out.doc_id.notna()].set_index("doc_id")
    assert named.loc[[1, 2, 3, 13], "component_id"].tolist() == [1] * 4
    assert named.loc[[7, 8], "component_id"].tolist() == [7, 7]
    assert named.loc[[4, 5, 6], "n_shingles"].tolist() == [0] * 3
    assert named.loc[[4, 5, 6], "component_id"].tolist() == [4, 5, 6]
    assert named.loc[9, "n_shingles"] == 1 and named.loc[10, "n_shingles"] == 1
    lost = out[out.doc_id.isna()]
    assert sorted(lost["component_id"].fillna(-1)) == [-1, 1]


def test_no_rows(spark):
    assert nj.jaccard_components(no_docs(spark)).count() == 0


@pytest.mark.parametrize("num", [50, 80, 85, 95])
def test_every_close_pair_shares_a_key(num):
    """Any two sets within the bound meet under a key, whatever the plan of the band."""
    draw = np.random.default_rng(num)
    edges = nj.bands(400, num, 100)
    for count in (2, 1000, 10**9):
        plans = [nj.allocate(*e, count, num, 100) for e in edges]
        for size in (1, 2, 3, 7, 12, 40, 250):
            for _ in range(25):
                x = np.unique(draw.integers(0, 2**63, size).astype(np.uint64))
                out = len(x) - -(-len(x) * num // 100)
                y = x[draw.permutation(len(x))[: len(x) - out]] if len(x) > out else x
                a, b = (set(nj.index_keys(*nj.hashed(s), edges, plans, num, 100).tolist()) for s in (x, np.sort(y)))
                assert a & b


def test_sketches_never_exceed_the_distance():
    draw = np.random.default_rng(0)
    for _ in range(50):
        x = np.unique(draw.integers(0, 2**63, draw.integers(1, 3000)).astype(np.uint64))
        y = np.unique(np.concatenate([x[draw.random(len(x)) < 0.8], draw.integers(0, 2**63, 50).astype(np.uint64)]))
        distance = len(np.setxor1d(x, y))
        assert nj.sketch_distance(nj.sketch(nj.hashed(x)[0]), nj.sketch(nj.hashed(y)[0])) <= distance


@pytest.mark.parametrize("nearest", [False, True])
def test_small_and_large_groups_give_the_same_pairs(monkeypatch, nearest):
    """Groups of one block and of two, of sets of many sizes, by lists of pairs and by strips."""
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (40, 43, 150, 160, 600, 640)]
    sets = [np.unique(np.where(draw.random(len(s)) < 0.015 * k, draw.integers(0, 2**63, len(s)).astype(np.uint64), s)) for s in sets for k in range(5)]
    rows = []
    for key in range(6):
        for i in draw.permutation(len(sets))[:20]:
            low, high = (0, 0) if key % 2 else (0, 1)
            rows.append((key, low, high, int(i) % 2 if high else 0, int(i), int(i) // 2, len(sets[i]), nj.sketch(nj.hashed(sets[i])[0])))
    rows.sort(key=lambda r: r[:4])
    kinds = [pa.int64()] * 7 + [pa.binary()]
    batch = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list("abcdefgh"))

    def pairs(step, small):
        monkeypatch.setattr(nj, "SMALL_GROUP", small)
        parts = (batch.slice(i, step) for i in range(0, batch.num_rows, step))
        found = [p for out in nj._possible(parts, 85, 100, nearest) for p in zip(*(c.to_pylist() for c in out.columns))]
        return {p[:2] for p in found if p[2] is None}, {p[2] for p in found} - {None}

    listed, more = pairs(7, 64)
    assert len(listed) > 10
    strips, left = pairs(7, 0)  # folded to the group's shortest sketch, so some more may stay
    if nearest:
        monkeypatch.setattr(nj, "SMALL_GROUP", 64)
        every = [p for out in nj._possible([batch], 85, 100, False) for p in zip(*(c.to_pylist() for c in out.columns))]
        assert listed <= {p[:2] for p in every} and more
        assert {x // 2 for p in listed for x in p} == {x // 2 for p in every for x in p[:2]}
        assert more <= left | more and len(listed) <= 6 * 14
    else:
        assert (listed, more) == pairs(200, 64) and not more and not left
        assert listed <= strips and len(strips) < 3 * len(listed)
    assert all(a < b and a // 2 != b // 2 for a, b in listed)


@pytest.mark.parametrize("block", [3, 4096])
def test_pairs_in_blocks_equal_all_pairs(spark, monkeypatch, block):
    """Sets under one key, in components of three: every pair across them that is close enough."""
    monkeypatch.setattr(nj, "BLOCK", block)
    draw = np.random.default_rng(5)
    base = draw.integers(0, 2**63, 300).astype(np.uint64)
    sets = [np.unique(np.where(draw.random(300) < 0.06 * (i % 4), draw.integers(0, 2**63, 300).astype(np.uint64), base)) for i in range(20)]
    placed = spark.createDataFrame([(1, i, i // 3) for i in range(20)], "key long, node long, root long")
    rows = [(i, len(s), nj.sketch(nj.hashed(s)[0])) for i, s in enumerate(sets)]
    found = nj.possible_links(placed, spark.createDataFrame(rows, "node long, n long, sketch binary"), 85, 100)
    assert found.filter("more is not null").isEmpty()
    got = {(r.a, r.b) for r in found.collect()}
    close = {
        (i, j)
        for i in range(20)
        for j in range(i)
        if i // 3 != j // 3 and 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))
    }
    assert {(b, a) for a, b in close} <= got and all(a < b and a // 3 != b // 3 for a, b in got)
    assert len(got) < 150


def test_keys_in_parts(spark, monkeypatch):
    """Keys taken in three parts give the components of all pairs; each part is smaller than all."""
    docs, taken, inner = small(spark, "documents"), [], nj.possible_links

    def counted(placed, *rest):
        taken.append(placed.count())
        return inner(placed, *rest)

    monkeypatch.setattr(nj, "possible_links", counted)
    monkeypatch.setattr(nj, "_parts", lambda *_: 3)
    got = {r.doc_id: r.component_id for r in nj.jaccard_components(docs, 5, 60, 100).collect()}
    assert got == nj.brute_force(docs.toPandas(), 5, 60, 100)
    assert len(taken) >= 3 and max(taken) < sum(taken)


def test_parts_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(nj, "PART_BYTES", 1)
    placed = spark.createDataFrame([(k, i, i) for k in range(10) for i in range(8)], "key long, node long, root long")
    sets = spark.createDataFrame([(i, 40, bytes(64), bytes(320)) for i in range(8)], "node long, n long, sketch binary, items binary")
    assert nj._parts(placed, sets) == -(-10 * 8 * (64 + nj.ROW_BYTES) * 2 // (8 * 320))
    assert nj._parts(placed.withColumn("root", placed.key), sets) == 1


def test_bundled_keys_are_those_of_several_sets(monkeypatch):
    """Keys in buckets, from tasks that saw copies of the same sets; six bytes a key, or less."""
    monkeypatch.setattr(nj, "KEYS_AT_ONCE", 500)
    draw = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(draw.permutation(words)) for _ in range(6)] + [" ".join(words)] * 2
    for k in range(12):
        words[5 * k] = f"edit{k}"
        texts.append(" ".join(words))
    tasks = [texts, texts[3:9], texts[:2]]  # rows that other tasks have, too
    edges = nj.bands(80, 85, 100)
    plans = [nj.allocate(*e, 1000, 85, 100) for e in edges]
    owners, node_rows, rows = {}, {}, []
    for task in tasks:
        for s in nj.shingle_sets(pa.array(task), 4):
            dealt, value = nj.hashed(s)
            node_rows[nj.set_key(value)] = node_rows.get(nj.set_key(value), 0) + 1
            for key in nj.short(nj.index_keys(dealt, value, edges, plans, 85, 100)).tolist():
                owners.setdefault(key, set()).add(nj.set_key(value))
    bits = np.zeros(1 << 10, np.uint64)
    slots = nj.common.spark_hash(np.array([x for x, k in node_rows.items() if k > 1], np.int64).view(np.uint64)) >> np.uint64(48)
    np.bitwise_or.at(bits, (slots >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slots & np.uint64(63)))
    assert 0 < len(slots) < len(node_rows)

    class Sent:
        value = bits

    for task in tasks:
        batch = pa.record_batch([pa.array(task)], ["text"])
        for out in nj._bundles([batch], 4, edges, plans, 85, 100, Sent, 16):
            rows += zip(*(c.to_pylist() for c in out.columns))
    assert max(r[0] for r in rows) < 16 and sum(len(r[1]) for r in rows) > 0 < sum(len(r[3]) for r in rows)
    assert all(len(r[1]) % 6 == 0 and len(r[2]) // 6 == len(r[3]) // 8 for r in rows)
    rows.sort(key=lambda r: r[0])
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    whole = pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "alone", "key", "node"])
    parts = [whole.slice(i, 7) for i in range(0, whole.num_rows, 7)]
    found = [k for out in nj._shared(parts) for k in out.column(0).to_pylist()]
    assert sorted(found) == sorted(k for k, nodes in owners.items() if len(nodes) > 1) and found


def test_packed_texts_give_their_sets(monkeypatch):
    monkeypatch.setattr(nj.common, "PIECE_BYTES", 100)
    texts = ["", "one", "Ünï ▁ \U0001f600 of them", "long " * 3000, " \t", "a B c d e f"]
    pack = nj.zstandard.ZstdCompressor()
    got = list(nj.unpacked_sets([pack.compress(t.encode()) for t in texts], 4))
    assert [s.tolist() for s in got] == [s.tolist() for s in nj.shingle_sets(pa.array(texts), 4)]


def test_disk_of_the_join(spark, monkeypatch):
    """Tables and shuffle files of the join take less than its texts do (twice as much before)."""
    draw = np.random.default_rng(1)
    lexicon = np.array([f"word{i}" for i in range(3000)])
    rows = []
    for k in range(1500):
        words = lexicon[draw.integers(0, 3000, 300)]
        for copy in range(2):
            rows.append((2 * k + copy, " ".join(words)))
            words = words.copy()
            words[10] = "edited"
    held, inner = {}, nj.stored

    def sized(df, name):
        out = inner(df, name)
        held[name] = sum(os.path.getsize(f.removeprefix("file:")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(nj, "stored", sized)
    out = nj.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in out.collect()} == set(range(0, 3000, 2))
    assert sum(held.values()) < sum(len(t) for _, t in rows)


def test_shuffle_files_go_with_the_write(spark):
    """Before, the files stayed until the driver's garbage was collected, or longer."""
    folders = [f.getPath() for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    sent = lambda: sum(os.path.getsize(os.path.join(r, f)) for d in folders for r, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_"))
    before = sent()
    table = nj.stored(spark.range(200_000).groupBy(F.xxhash64("id").alias("k")).count(), "counted")
    for _ in range(50):
        if sent() <= before:
            break
        time.sleep(0.1)
    assert sent() <= before and table.count() == 200_000
    assert spark.conf.get(nj.common.FILE_CLEANUP, None) is None


def test_large_tables_are_gone_before_the_result(spark, monkeypatch):
    made, inner = {}, nj.stored

    def noted(df, name):
        out = inner(df, name)
        made.setdefault(name, out.inputFiles()[0].removeprefix("file:"))
        return out

    monkeypatch.setattr(nj, "stored", noted)
    out = nj.jaccard_components(odd_docs(spark))
    assert [x for x in ("shared-keys", "keyed-nodes", "sets", "members") if os.path.exists(made[x])] == []
    assert out.count() == 17
