import base64
import hashlib

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tests.llm.helpers import awkward_documents, empty_documents, words
from tillcast.llm import bytebpe

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bytebpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def told(library, text):
    ids = library.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


AWKWARD = [
    "I'll can't 's x'ab 12'3s", "a \n\n  b\t\tc  ", "x" * 5_000, " " * 9_000, " " * 9_000 + "end", "a  b c　　　d",
    "\x1c\x1d a \x85\x85 b ​᠎ c", "日本語 テキスト。" * 900, "emoji \U0001f642\U0001f468‍\U0001f469 <|endoftext|>", "\n" * 6_000 + "x",
]


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_pieces_encode_like_the_whole_text(ranks, library, piece, monkeypatch):
    codec = bytebpe.Codec(ranks, PATTERN)
    monkeypatch.setattr(bytebpe, "safe_pieces", lambda text, f=bytebpe.safe_pieces: f(text, piece))
    for text in [*AWKWARD, words(400, 1), "".join(AWKWARD)]:
        ids = codec.encode(text)
        assert ids == library.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()
        assert codec.digests(text) == told(library, text)


def test_long_runs_do_not_overflow(ranks):
    codec = bytebpe.Codec(ranks, PATTERN)
    text = "a" + " " * 1_500_000 + "b c\n" + "\t" * 300_000
    ids = codec.encode(text)
    assert codec.decode(ids) == text.encode()
    # the last space goes with the word behind it
    assert codec.encoding.decode_single_token_bytes(ids[1_500_000]) == b" b"


def test_query_equals_the_library(spark, ranks, library):
    docs = awkward_documents(spark, [(100 + i, t, "en", "a") for i, t in enumerate(AWKWARD)])
    got = sorted(map(tuple, bytebpe.encode_digests(docs, ranks, PATTERN).collect()), key=str)
    assert got == sorted(((r.doc_id, *told(library, r.text)) for r in docs.collect()), key=str)


def test_columns_round_trip(spark, ranks, library):
    docs = awkward_documents(spark)
    ids = docs.select("text", bytebpe.encode_column(F.col("text"), ranks, PATTERN).alias("ids"))
    for r in ids.select("text", "ids", bytebpe.decode_column(F.col("ids"), ranks, PATTERN).alias("bytes")).collect():
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.bytes) == (r.text or "").encode()
    none = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r[0] for r in none.select(bytebpe.decode_column(F.col("ids"), ranks, PATTERN)).collect()] == [None, b""]


def test_empty(spark, ranks):
    assert bytebpe.encode_digests(empty_documents(spark), ranks, PATTERN).count() == 0


def test_rank_file_is_bounded(tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_bytes(b"IQ== 0\n")
    monkeypatch.setattr(bytebpe, "MAX_RANK_BYTES", 3)
    with pytest.raises(ValueError):
        bytebpe.read_ranks(str(path))
