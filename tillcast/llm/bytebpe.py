"""Byte-level BPE encoding and decoding with the tiktoken library.

The encoder is built in each Python worker from the bytes of a local rank file.
The library's regular expression backtracks over white space, so a very long
run of it overflows its stack, and one call holds all ids of its text. Long
texts are therefore cut first where every match must end: between a character
that is no white space and one that is. No match of the split pattern holds
white space behind anything else, and what follows the cut is matched without a
look at what precedes it. A run of white space longer than ``LONG_RUN`` is one
match by itself (all of it at the end of the text, else all but its last
character) and goes to the merges without the expression.

Ids decode to the bytes of their tokens, joined; decoding piece by piece gives
the same bytes because no token depends on its neighbours.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import prepare

MAX_RANK_BYTES = 64 << 20
PIECE = 1 << 16  # characters handed to the library at once, and up to the next safe cut
LONG_RUN = 1 << 12

# Unicode's White_Space, as the library's expression reads \s.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_WHITE = re.compile(f"[{WHITE}]{{{LONG_RUN},}}")
_SAFE_CUT = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file: one base64 token and its rank a line."""
    with open(path, "rb") as f:
        ranks = f.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"the rank file is larger than {MAX_RANK_BYTES} bytes")
    return ranks


def safe_pieces(text: str, piece: int = PIECE) -> Iterator[tuple[str, bool]]:
    """``(part, alone)`` of a text in order; ``alone`` marks a part that is one match."""
    at = 0
    for run in _LONG_WHITE.finditer(text) if len(text) > piece else ():
        yield from _plain_pieces(text, at, run.start(), piece)
        at = run.end() if run.end() == len(text) else run.end() - 1
        yield text[run.start() : at], True
    yield from _plain_pieces(text, at, len(text), piece)


def _plain_pieces(text: str, at: int, end: int, piece: int) -> Iterator[tuple[str, bool]]:
    while at < end:
        cut = _SAFE_CUT.search(text, at + piece, end) if end - at > piece else None
        to = cut.start() if cut else end
        yield text[at:to], False
        at = to


class Codec:
    """Encoding and decoding by one rank file and one split pattern, no special tokens."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def pieces(self, text: str) -> Iterator[list[int]]:
        """Lists of ids, in order; joined they are the ids of the text."""
        for part, alone in safe_pieces(text):
            yield self.encoding._encode_single_piece(part) if alone else self.encoding.encode_ordinary(part)

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.pieces(text) for i in ids]

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as little-endian 32-bit integers, and of the decoded bytes."""
        n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
        for ids in self.pieces(text):
            n += len(ids)
            of_ids.update(np.asarray(ids, dtype="<u4").tobytes())
            of_bytes.update(self.decode(ids))
        return n, of_ids.hexdigest(), of_bytes.hexdigest()


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(ranks: bytes, pattern: str) -> Codec:
    """One codec for each rank file and Python worker."""
    key = (hash(ranks), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(ranks, pattern)
    return _CODECS[key]


def encode_column(text: Column, ranks: bytes, pattern: str) -> Column:
    """``array<int>`` of ids; a null text encodes as an empty one."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(ranks, pattern)
        for texts in batches:
            yield pd.Series([codec.encode(t or "") for t in texts], dtype=object)

    return encode(text)


def decode_column(ids: Column, ranks: bytes, pattern: str) -> Column:
    """Bytes of an ``array<int>``, null for null; an id outside the ranks is an error."""

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(ranks, pattern)
        for lists in batches:
            yield pd.Series([None if x is None else codec.decode([int(i) for i in x]) for x in lists], dtype=object)

    return decode(ids)


def encode_digests(docs: DataFrame, ranks: bytes, pattern: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

    A null text counts as empty: no ids, and the digests of no bytes. A text of
    any length is encoded whole, with the ids of one piece in memory at a time.
    Repeated rows (and ties of any kind) give repeated rows, an empty table
    none; columns other than ``doc_id, text`` are not read, so they may have
    any name.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(ranks, pattern)
        for texts in batches:
            rows = [codec.digests(t or "") for t in texts]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    told = docs.select("doc_id", digest(F.col("text")).alias("told"))
    return told.select("doc_id", "told.n_tokens", "told.ids_sha256", "told.decoded_sha256")
