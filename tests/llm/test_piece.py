import hashlib

import public_tokenizers
import pytest
import sentencepiece

from llm.helpers import awkward_documents, empty_documents
from tillcast.llm import piece
from tillcast.llm.queries import piece_model


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def wanted(library, text):
    ids = library.encode(text or "", add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_digests_equal_the_library(spark, library):
    docs = awkward_documents(spark)
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in piece.encode_digests(docs, piece_model()).collect())
    assert got == sorted((r.doc_id or -1, *wanted(library, r.text)) for r in docs.collect())
    assert piece.encode_digests(empty_documents(spark), piece_model()).count() == 0


def test_encoder_on_hard_texts(library):
    encoder = piece.Encoder(piece_model())
    texts = ["  a  b ", "▁x", "a▁▁b", "\n\n x\n", "<s></s><unk><0x0A>", "日本\U0001f642\x00", "ab" * 3000, "the" * 999, " ", "�"]
    for t in texts:
        assert encoder.encode(t) == library.encode(t, add_eos=True), t[:40]
        assert encoder.decode(encoder.encode(t)) == library.decode(library.encode(t, add_eos=True))


def test_columns_round_trip(spark):
    from pyspark.sql import functions as F

    docs = awkward_documents(spark).where("text is not null")
    piece.prepare(spark)
    both = docs.select("text", piece.encode_column(F.col("text"), piece_model()).alias("ids"))
    back = both.select("text", piece.decode_column(F.col("ids"), piece_model()).alias("back"))
    assert all(r.text == r.back for r in back.collect())
