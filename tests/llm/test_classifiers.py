import numpy as np
import pyarrow as pa
import pytest

from ledgerlens.llm import quality, toxicity
from odd_rows import no_docs, odd_docs, small

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.parametrize("learn, column, least", [(toxicity.toxicity, "toxic", 0.97), (quality.quality, "quality", 0.95)])
def test_held_out_accuracy(spark, learn, column, least):
    docs, labels = small(spark, "documents", FOLDER), small(spark, "labels", FOLDER)
    out = learn(docs, labels).filter("held_out").join(labels, "doc_id").toPandas()
    assert ((out["predicted"] == 1) == (out[column] == 1)).mean() > least
    assert out["score"].between(0, 1).all()


@pytest.mark.parametrize("learn", [toxicity.toxicity, quality.quality])
def test_odd_rows(spark, learn):
    labels = spark.createDataFrame(
        [(1, 1, 0), (7, 0, 1), (7, 0, 1), (None, 1, 1), (3, None, None), (99, 1, 1)], "doc_id long, quality int, toxic int"
    )
    out = learn(odd_docs(spark, with_clashes=True), labels).toPandas()
    assert len(out) == 17 and out["score"].between(0, 1).all() and out["held_out"].notna().all()
    alike = out[out.doc_id.isin([4, 5])]["score"]
    assert alike.nunique() == 1
    assert learn(no_docs(spark), labels).count() == 0
    assert learn(odd_docs(spark), labels.filter("false")).count() == 17


def test_toxicity_word_by_word():
    model = toxicity.Model(np.random.default_rng(0).normal(size=1 << toxicity.BUCKET_BITS).astype(np.float32), -0.5, 5)
    texts = ["", None, "One", "a b c d e f g", "Idiot, näh " * 9, "x" * 300]
    got = model.probabilities(pa.array(texts))
    assert np.allclose(got, [toxicity.brute_force_score(model, t) for t in texts], atol=1e-5)


def test_convolution_by_loops():
    net = quality.train(pa.array(["a"]), np.zeros(1), 0.0)
    draw = np.random.default_rng(1)
    net.out = draw.normal(size=net.out.shape).astype(np.float32)
    for text in (b"", b"Some text. " * 5, b"abcabcabcabc" * 100):
        batch = quality.Batch.of([text])
        x = batch.data
        repeated = [
            int(any(i >= lag and bytes(x[i : i + 8]) == bytes(x[i - lag : i - lag + 8]) and x[i : i + 8].all() and len(x[i : i + 8]) == 8 for lag in range(1, 25)))
            for i in range(len(x))
        ]
        assert batch.repeated.tolist() == repeated
        values = []
        for i in range(0, len(x) - quality.TAPS * quality.STRIDE, quality.STRIDE):
            z = net.bias.astype(float).copy()
            for k in range(quality.TAPS * quality.STRIDE):
                row = np.append(net.embedding[x[i + k]], repeated[i + k])
                z += row @ net.filters.reshape(-1, quality.CHANNELS, quality.FILTERS)[k]
            values.append(z)
        halves = np.array(values).reshape(-1, quality.PER_HALF, quality.FILTERS).max(1)
        chunks = np.maximum(halves[:-1], halves[1:]) if len(halves) > 1 else halves
        chunks = np.maximum(chunks, 0)
        logit = np.concatenate([chunks.mean(0), chunks.max(0)]) @ net.out + net.shift
        assert net.logits([text])[0] == pytest.approx(logit, abs=1e-3)
