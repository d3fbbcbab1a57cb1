import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import pieces as sp
from odd_rows import no_docs, odd_docs, small

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TABLE = sp.PieceTable.load(MODEL)


def encode(texts):
    return sp.PieceEncoder(TABLE).encode(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=5))
def test_round_trip(texts):
    assert sp.PieceDecoder(TABLE).decode(*encode(texts)) == texts


@pytest.mark.parametrize("text", ["Hello world, this is a test.", "aaaaaaaaaaaa", "internationalization  of   spaces", "été über"])
def test_best_score(text):
    ids, _ = encode([text])
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert not any(library.is_byte(int(i)) for i in ids)
    assert sum(library.get_score(int(i)) for i in ids) == pytest.approx(sp.viterbi_plain(text, MODEL))


def test_library_decodes_the_ids():
    text = "Plain words; Ünïcode \U0001f600 too."
    ids, _ = encode([text])
    assert sentencepiece.SentencePieceProcessor(model_file=MODEL).decode([int(i) for i in ids]) == text


def test_tables(spark):
    for docs in (small(spark, "documents"), odd_docs(spark, with_clashes=True), no_docs(spark)):
        tokens = sp.encode_pieces(docs, MODEL, checksum=True)
        assert tokens.columns == [*docs.columns, "token_ids", "ids_crc32"]
        out = sp.decode_pieces(tokens, MODEL).collect()
        assert len(out) == docs.count()
        for r in out:
            assert r.decoded == (r.text or "") and r.ids_crc32 == sp.crc32_of(r.token_ids)
