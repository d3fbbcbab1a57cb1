import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import maxent_lm as lm
from odd_rows import no_docs, odd_docs, small

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture
def few_frequent(monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)


def test_base_and_gain(spark, few_frequent):
    docs = small(spark, "documents", FOLDER)
    out = lm.lm_scores(docs).toPandas().set_index("doc_id")
    plain = lm.base_plain(docs.toPandas(), out["held_out"].to_dict())
    for d, (n, known, total, score) in plain.items():
        row = out.loc[d]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (n, known, total)
        assert row.base_score == pytest.approx(score, rel=1e-9)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    out = lm.lm_scores(small(spark, "documents", FOLDER)).toPandas()
    held = out[out.held_out]
    assert held["score"].sum() > 0.95 * held["base_score"].sum()


@pytest.fixture(scope="module")
def fitted(spark):
    docs = small(spark, "documents")
    vocabulary = docs.select("text").mapInArrow(lm._counts, "word long, ending int, n long").groupBy("word").agg({"ending": "max", "n": "sum"})
    vocabulary = vocabulary.toDF("word", "ending", "n").persist()
    return lm.fit(docs, vocabulary, 2), vocabulary.toPandas()


TEXTS = ["Some text here, some text there", "", None, "the the the end of the text is here", "x"]


def plain_mix(x):
    for shift, by in ((30, int(lm.K2)), (27, int(lm.K3))):
        x = (x ^ x >> shift) * by % 2**64
    return x ^ x >> 31


def plain_histories(model, t):
    """Per token its cell and logits: over groups, and over the cells of each group."""
    cells, table, out = model.cells, model.table.astype(float), []
    start = int(lm.START)
    for low, high in zip(t.first, t.first[1:]):
        seen = []
        for i in range(low, high):
            word = t.hash[i]
            single = np.flatnonzero(cells.words == word)
            cell = int(cells.own[single[0]] if len(single) else cells.of_ending[t.ending[i]])
            (one, near), (two, far) = ([*reversed(seen), (start, lm.END_CELL), (start, lm.END_CELL)])[:2]
            kinds = [one, one * int(lm.K2) + two, two, near * lm.CELLS + far + int(lm.K3)]
            mixed = [plain_mix(x % 2**64) for x in kinds]
            outer = sum(table[k * lm.OUTER + (h >> 52)] for k, h in enumerate(mixed))
            inner = []
            for g in range(lm.GROUPS):
                place = [int(cells.start[g]) + (h % 2**32 * int(cells.rows[g]) >> 32) for h in mixed]
                inner.append(sum(table[4 * lm.OUTER + k * lm.INNER + r] for k, r in enumerate(place)))
            out.append((cell, outer, inner))
            seen.append((int(word), cell))
    return out


def test_history_against_plain_softmax(fitted):
    model, _ = fitted
    t = lm.tokens(*lm.text_bytes(pa.array(TEXTS)))
    got = lm.history_logs(model.table, model.cells, t, model.cells.of(t))
    plain = plain_histories(model, t)
    assert len(got) == len(plain) == 21
    for value, (cell, outer, inner) in zip(got, plain):
        p = np.exp(outer) / np.exp(outer).sum()
        q = np.exp(inner) / np.exp(inner).sum(1, keepdims=True)
        assert (p[:, None] * q).sum() == pytest.approx(1)
        assert value == pytest.approx(np.log((p[:, None] * q).ravel()[cell]), abs=1e-4)


def test_words_of_a_cell_sum_to_one(fitted):
    model, words = fitted
    t = lm.Tokens(words["word"].to_numpy().view(np.uint64), words["ending"].to_numpy(), np.zeros(1, np.int64))
    cell = model.cells.of(t)
    within = np.bincount(cell, (words["n"] + 1) / model.cell_total[cell], lm.CELLS) + 1 / model.cell_total
    assert np.allclose(within, 1) and len(model.cells.words) == lm.OWN
    assert (np.bincount(cell, minlength=lm.CELLS)[np.unique(model.cells.own)] == 1).all()
    assert model.cells.rows.sum() == lm.INNER and model.cells.rows.min() > 0


def test_gradient_against_plain_softmax(fitted):
    model, _ = fitted
    batch = lambda: iter([pa.record_batch([pa.array(TEXTS)], ["text"])])
    sums = {}
    for name, task in (("seen", lm._observed(batch(), model.cells)), ("expected", lm._expected(batch(), model.cells, model.table))):
        frame = next(task).to_pandas().set_index("row")
        sums[name] = frame.sort_index()
    t = lm.tokens(*lm.text_bytes(pa.array(TEXTS)))
    cell = model.cells.of(t)
    outer, inner = lm.features(t, cell, model.cells)
    for rows, choice in ((outer, cell // lm.WIDE), (inner, cell % lm.WIDE)):
        for r in rows:
            for i in range(len(cell)):
                z = sum(model.table[x[i]].astype(float) for x in rows)
                p = np.exp(z) / np.exp(z).sum()
                sums["seen"].loc[r[i], f"c{choice[i]}"] -= 1
                sums["expected"].loc[r[i]] -= p
    assert np.allclose(sums["seen"], 0) and np.allclose(sums["expected"], 0, atol=1e-4)


def test_odd_rows(spark):
    out = lm.lm_scores(odd_docs(spark, with_clashes=True)).toPandas()
    assert len(out) == 17 and out["score"].notna().all() and (out["score"] < 0).all()
    named = out[out.doc_id.notna()].drop_duplicates("doc_id").set_index("doc_id")
    assert named.loc[[4, 5, 6], "n_tokens"].tolist() == [1, 1, 1] and named.loc[10, "n_tokens"] == 30_001
    assert lm.lm_scores(no_docs(spark)).count() == 0
