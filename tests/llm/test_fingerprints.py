import hashlib

import numpy as np

from ledgerlens.llm import fingerprints as fp
from odd_rows import no_docs, odd_docs, small


def test_entropy_classes():
    data = np.random.default_rng(0).integers(0, 40, 3000).astype(np.uint8)
    data[500:700] = 7
    got = fp.entropy_classes(data)
    for i in range(0, len(got), 37):
        assert abs(got[i] - fp.entropy_plain(data[i : i + fp.WINDOW].tobytes()) / 6 * (fp.CLASSES - 1)) <= 1.01


def test_batches_do_not_matter():
    draw = np.random.default_rng(1)
    texts = [draw.integers(97, 120, n).astype(np.uint8).tobytes() for n in (0, 5, 63, 64, 65, 500, 40_000, 0)]
    digester = fp.Digester(fp.ranks(np.arange(fp.CLASSES)))
    together = [str(d) for d in digester.digests(texts)]
    assert together == [str(digester.digests([t])[0]) for t in texts]
    a, b = digester.digests([texts[6], texts[6][:20_000] + texts[6][21_000:]])
    assert a.likeness(a) == 1 and a.likeness(b) > 0.5 and a.likeness(b) == b.likeness(a)
    c = digester.digests([draw.integers(97, 120, 30_000).astype(np.uint8).tobytes()])[0]
    assert a.likeness(c) < 0.1
    empty, short = digester.digests([b"", b"short"])
    assert empty.likeness(empty) == 1 and empty.likeness(a) == 0 and short.likeness(short) == 1


def neighbours(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    rows.sort(key=lambda r: -1 if r[0] is None else r[0], reverse=True)
    out = {}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        k = len(t) // 3
        out.setdefault(d, set()).add(hashlib.sha256((t[: len(t) - k] + after[:k]).encode()).hexdigest())
    return out


def test_beside_next(spark, monkeypatch):
    docs = small(spark, "documents", "/root/testdata/sf0.01")
    expect = neighbours(docs)
    for size in (fp.STREAM_BYTES, 200_000):
        monkeypatch.setattr(fp, "STREAM_BYTES", size)
        out = fp.beside_next(docs).toPandas()
        assert len(out) == docs.count()
        assert all({s} == expect[d] for d, s in zip(out["doc_id"], out["edited_sha256"], strict=True))
        assert out["near_edited"].mean() > out["near_next"].mean() + 0.3
        assert out[["near_edited", "near_next"]].stack().between(0, 1).all()
    rank = fp.rarity(docs)
    digests = fp.Digester(rank).digests([r.text.encode() for r in docs.orderBy("doc_id").collect()])
    assert out.sort_values("doc_id")["fingerprint"].tolist() == [str(d) for d in digests]


def test_odd_rows(spark):
    docs = odd_docs(spark, with_clashes=True)
    out = fp.beside_next(docs).toPandas()
    assert len(out) == 17 and out["fingerprint"].notna().all()
    named = out[out.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert named.loc[1, "fingerprint"] == named.loc[2, "fingerprint"] and named.loc[4, "fingerprint"] == "0:"
    assert fp.beside_next(no_docs(spark)).count() == 0
    plain = fp.fingerprints(docs).toPandas()
    assert sorted(plain["fingerprint"]) == sorted(out["fingerprint"])
