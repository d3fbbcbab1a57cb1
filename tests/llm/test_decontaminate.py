import random

from ledgerlens.llm import decontaminate as dc
from odd_rows import no_docs, odd_docs, small


def test_myers_equals_the_full_table():
    draw = random.Random(1)
    for _ in range(200):
        p = "".join(draw.choices("abc", k=draw.randint(1, 90)))
        t = "".join(draw.choices("abc", k=draw.randint(1, 40)))
        assert min(dc.myers(p, t)) == dc.edit_distance_within(p, t)


def test_edits_within_the_budget_are_found():
    draw = random.Random(2)
    finder = dc.Finder([(1, dc.normalized("The quick brown fox jumps over the lazy dog again and again, they say. " * 2))], 0.05)
    item = finder.items[0][1]
    for errors in range(finder.items[0][2] + 1):
        changed = list(item)
        for at in draw.sample(range(len(item)), errors):
            changed[at] = draw.choice(["", "#", changed[at] + "#"])
        text = "Some words before. " + "".join(changed).upper() + "  some after"
        (found,) = finder.hits(text)
        assert found[0] == 1 and found[1] <= errors
        assert found[1] == dc.edit_distance_within(item, dc.normalized(text))
    assert finder.hits("nothing of the kind") == []


def test_planted_items(spark):
    docs, benchmark = small(spark, "documents", "/root/testdata/sf0.01"), small(spark, "benchmark", "/root/testdata/sf0.01")
    got = {r.doc_id for r in dc.benchmark_hits(docs, benchmark).filter("size(hits) > 0").collect()}
    items = [dc.normalized(r.text) for r in benchmark.collect()]
    expect = {r.doc_id for r in docs.collect() if any(i in dc.normalized(r.text) for i in items)}
    assert expect and expect <= got


def test_blocks_give_the_same(spark, monkeypatch):
    docs, benchmark = small(spark, "documents"), small(spark, "benchmark")
    whole = sorted((r.doc_id, sorted(h.item_id for h in r.hits)) for r in dc.benchmark_hits(docs, benchmark).collect())
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (2000,))
    parts = sorted((r.doc_id, sorted(h.item_id for h in r.hits)) for r in dc.benchmark_hits(docs, benchmark).collect())
    assert whole == parts


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "word0x0 word1x7 WORD2x14"), (2, None), (3, ""), (None, "two words"), (1, "x")], "item_id long, text string")
    docs = odd_docs(spark, with_clashes=True)
    out = dc.benchmark_hits(docs, items)
    assert out.columns == [*docs.columns, "hits"]
    got = {r.doc_id: [h.item_id for h in r.hits] for r in out.filter("doc_id is not null").collect()}
    assert got[9] == [None] and got[4] == [] and 1 in got[1] and 1 in got[13]
    assert out.count() == 17 and dc.benchmark_hits(no_docs(spark), items).count() == 0
    assert dc.benchmark_hits(docs, items.filter("false")).filter("size(hits) > 0").count() == 0
