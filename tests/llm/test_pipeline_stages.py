import corpus_pipeline as cp
from odd_rows import DOC, SMALL


def documents(spark, rows):
    return spark.createDataFrame([(d, t, "en", "src0", len(t)) for d, t in rows], DOC)


def numbered(name, count, changed=()):
    return " ".join(f"other{i}" if i in changed else f"{name}{i}" for i in range(count))


def test_one_of_each_group_where_ids_are_repeated(spark):
    """Of (5, A) and (5, B) only the first is a copy of an earlier row."""
    a, b, near_b = numbered("a", 60), numbered("b", 200), numbered("b", 200, {199})
    docs = documents(spark, [(3, a), (5, a), (5, b), (9, near_b), (9, ""), (10, "")])
    got = sorted((r.doc_id, r.text) for r in cp.one_of_each_group(spark, docs, SMALL).collect())
    assert got == sorted([(3, a), (5, b), (9, ""), (10, "")])


def test_near_copies_by_five_words(spark):
    """Four replaced words of 200: 176 of 216 five-word sequences are shared, six leave too few."""
    text, near, far = numbered("w", 200), numbered("w", 200, {30, 70, 110, 150}), numbered("w", 200, {20, 50, 80, 110, 140, 170})
    docs = documents(spark, [(1, text), (2, near)])
    assert [r.doc_id for r in cp.one_of_each_group(spark, docs, SMALL).collect()] == [1]
    docs = documents(spark, [(1, text), (2, far)])
    assert sorted(r.doc_id for r in cp.one_of_each_group(spark, docs, SMALL).collect()) == [1, 2]
