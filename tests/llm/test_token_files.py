import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from ledgerlens.llm import token_files as tf
from odd_rows import no_docs, odd_docs, odd_rows, small

FILE = public_tokenizers.path("word_bpe_49k.json")


def plain(rows):
    """(doc_id, start, n_tokens, crc) by the library, a text at a time."""
    tokenizer, start, out = Tokenizer.from_file(FILE), 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def written(docs, folder):
    tf.write_tokens(docs, FILE, str(folder))
    return tf.read_tokens(docs.sparkSession, str(folder))


def test_equals_the_library(spark, tmp_path):
    docs = small(spark, "documents", "/root/testdata/sf0.01")
    got = sorted(map(tuple, written(docs, tmp_path / "t").collect()))
    assert got == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark, tmp_path):
    got = written(odd_docs(spark, with_clashes=True), tmp_path / "t").collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[3])
    expect = plain([r[:2] for r in odd_rows()])
    assert sorted([(r[0], 0, r[2], r[3]) for r in got], key=key) == sorted([(r[0], 0, *r[2:]) for r in expect], key=key)
    starts = sorted((r[1], r[2]) for r in got)
    assert [s for s, _ in starts] == np.cumsum([0, *(n for _, n in starts)])[:-1].tolist()
    ids = Tokenizer.from_file(FILE).encode(odd_rows()[11][1], add_special_tokens=False).ids
    assert tf.token_ids(spark, str(tmp_path / "t"), 12) == [ids + [1]]
    assert len(tf.token_ids(spark, str(tmp_path / "t"), 14)) == 2
    assert tf.token_ids(spark, str(tmp_path / "t"), 99) == []


def test_words_by_the_library():
    tokenizer = Tokenizer.from_file(FILE)
    encoder = tf.WordEncoder(open(FILE).read(), "<|endoftext|>", tokenizer.token_to_id("<|endoftext|>"))
    texts = ["Don't!! WON'T.", "<|ENDOFTEXT|>, <|endoftext|>. x<|endoftext|>.", "A\u030a. I\u0307! É, é.", "... . !a! 1.5, a.b.", "", None, "x.\u0301 (y.) z!?;:", "\u2003a\u00a0b.", "'s. 's!"]
    for _ in range(2):
        ids, first = encoder.encode(pa.array(texts))
        for t, a, b in zip(texts, first, first[1:], strict=False):
            assert ids[a:b].tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, t


def test_dictionary_sees_whole_documents(spark, tmp_path, monkeypatch):
    """A document of several samples' length is in the samples from its first id to its last."""
    text = " ".join(f"w{i} and" for i in range(60_000))
    seen = []
    train = tf.train_dictionary
    monkeypatch.setattr(tf, "train_dictionary", lambda samples, size: seen.extend(samples) or train(samples, size))
    written(spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string"), tmp_path / "t").count()
    ids = Tokenizer.from_file(FILE).encode(text, add_special_tokens=False).ids
    assert 2 * len(ids) > 3 * tf.SAMPLE_BYTES and max(map(len, seen)) <= tf.SAMPLE_BYTES
    assert b"".join(seen) == np.array(ids, "<u2").tobytes()


def test_no_rows(spark, tmp_path):
    assert written(no_docs(spark), tmp_path / "t").count() == 0


def test_another_dictionary_is_refused():
    data = tf.pack(2, tf.dictionary_hash(b"one"), [])
    assert len(tf.Segment(data, b"one").doc_id) == 0
    with pytest.raises(ValueError):
        tf.Segment(data, b"two")


def test_words_of_letters_go_without_separators(monkeypatch):
    """Of new words only those that are not letters alone have a special token between them."""
    definition = open(FILE).read()
    tokenizer = Tokenizer.from_str(definition)
    encoder = tf.WordEncoder(definition, "<|endoftext|>", tokenizer.token_to_id("<|endoftext|>"))
    slow, separated = [], encoder._separated

    def counted(data, start, length):
        slow.extend(data[a : a + n].tobytes().decode() for a, n in zip(start, length, strict=True))
        return separated(data, start, length)

    monkeypatch.setattr(encoder, "_separated", counted)
    draw = np.random.default_rng(3)
    letters = list("abcdefghijklmnopqrstuvwxyz\u00e9\u00df\u03c3\u4e2d\u05d0")
    words = ["".join(draw.choice(letters, draw.integers(1, 12))) for _ in range(2000)]
    texts = [" ".join(words), "Abc*** x-- \u00c9t\u00e9. a|b c|> x' 'tis don't x2y \u0130x \u00a0 e\u0301a \u03a3\u03a3\u03a3 \u00aa\u02b0 \u0e01\u0e33 \u216b", "a__ b~~ (c) d\"\" e)!) f<> g>. <|startoftext|>*** z'*"]
    ids, first = encoder.encode(pa.array(texts))
    for t, a, b in zip(texts, first, first[1:], strict=False):
        assert ids[a:b].tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t
    assert 0 < len(slow) < 30 and not set(slow) & set(words)


def test_letters_that_the_tokenizer_cuts(monkeypatch):
    """A word that gives more ends than words takes its texts back to the separator."""
    definition = open(FILE).read()
    tokenizer = Tokenizer.from_str(definition)
    encoder = tf.WordEncoder(definition, "<|endoftext|>", tokenizer.token_to_id("<|endoftext|>"))
    encoder.ends[:] = True
    text = "some plain words in one line"
    assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    encoder.cache.clear()
    encoder.ends = None
    assert encoder.encode(pa.array([text]))[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
