import re

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerlens.llm.queries import QUERIES
from odd_rows import SMALL, no_docs, odd_docs


def test_one_query_for_each_operator():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 1 + max(int(n[2:].split("_")[0]) for n in QUERIES)))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_table(spark, name):
    out = QUERIES[name](spark, SMALL)
    table = "pages" if name.startswith(("op9", "op11")) else "documents"
    if not name.startswith(("op4", "op12", "op13")):
        assert out.count() == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


def test_pipeline_equals_its_parts(spark):
    from ledgerlens.llm import ngram_join, substring_dedup

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in corpus_pipeline.without_toxic(spark, docs, SMALL).collect()}
    frame = docs.filter(docs.doc_id.isin(list(texts))).toPandas()
    alike = ngram_join.brute_force(frame)
    frame = frame[[alike[d] == d for d in frame["doc_id"]]]
    left = substring_dedup.brute_force(frame)
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert set(got) <= set(left) and len(got) > 0.5 * len(left)


def test_stages_on_odd_rows(spark):
    for docs in (odd_docs(spark), no_docs(spark)):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            out.count()
            if stage is not corpus_pipeline.encoded:
                assert out.columns == list(corpus_pipeline.COLUMNS)
