"""SentencePiece encoding by backtracking over longest matches, and decoding.

The encoder finds the merge-type (BPE) segmentation without merging the text.
One Aho-Corasick pass lists the pieces that start at each character, longest
first. From left to right the longest piece is taken that is compatible with
the piece before it: the two stay apart when their joint text is merged again.
Where none fits, the position is marked in a bitfield of failed positions and
the last piece is taken back for its next shorter form. Two neighbours are
checked by re-merging their few characters; answers are kept in a table.

Merges never join a piece's end to a following space mark unless the
vocabulary holds such a piece, so words are encoded apart and frequent ones
are kept. The vocabulary is read from the model file on the driver and sent to
the tasks; its size is fixed by the file, not by the data.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import prepare

SPACE = "▁"
# What a Python worker remembers: two tables of words, some 200 bytes a word, and one of
# pairs, some 150 bytes a pair; about 290 MB together at most, whatever the texts hold.
REMEMBERED_WORDS = 500_000
REMEMBERED_LENGTH = 48
REMEMBERED_PAIRS = 600_000
MAX_MODEL_BYTES = 64 << 20


class Vocabulary:
    """Pieces of a merge-type model with an identity normaliser and byte fallback."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.end_id = sp.eos_id()
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.text: dict[int, str] = {}
        self.byte_of: dict[int, int] = {}
        for i in range(sp.vocab_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_of[i] = int(piece[3:5], 16)
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.score[piece] = sp.get_score(i)
                self.text[i] = piece.replace(SPACE, " ")
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")


class Encoder:
    """Exact merge-type encoding of words, and its inverse."""

    def __init__(self, model: bytes):
        import ahocorasick

        self.vocabulary = Vocabulary(model)
        self.ids = self.vocabulary.ids
        self.pairs: dict[tuple[str, str], bool] = {}
        # The ids of words as text; when the newer table is full it replaces the older.
        self.newer: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.automaton = ahocorasick.Automaton()
        # A piece that its own characters do not merge into never appears.
        live = {p for p in self.ids if len(p) == 1 or self.merge(p) == [p]}
        for piece in live:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.widest = max(map(len, live))
        fronts = {p: [p[:k] for k in range(len(p) - 1, 0, -1)] for p in live}
        # The next shorter piece at the same place; single characters always stand.
        self.shorter = {p: next((x for x in f if x in live or len(x) == 1), None) for p, f in fronts.items()}
        # Two characters that follow one another in some piece.
        self.joins = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.words_apart = not any(j[1] == SPACE and j[0] != SPACE for j in self.joins)
        self.lines_apart = not any("\n" in j for j in self.joins)

    def merge(self, text: str) -> list[str]:
        """Plain merging, best score first, leftmost on ties; for a pair of pieces."""
        score = self.vocabulary.score
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts))) + [-1]
        before = list(range(-1, len(parts) - 1))
        queue: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            joined = parts[i] + parts[j]
            if joined in score:
                heapq.heappush(queue, (-score[joined], i, j, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while queue:
            _, i, j, joined = heapq.heappop(queue)
            if parts[i] is None or parts[j] is None or after[i] != j or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [p for p in parts if p is not None]

    def compatible(self, left: str, right: str) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merge(left + right) == [left, right]
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            self.pairs[left, right] = known
        return known

    def segment(self, text: str) -> list[str]:
        """The pieces of one word; characters outside the vocabulary stand alone."""
        # The leftmost longest matches are the first path tried; most often no
        # neighbours clash and it stands.
        taken: list[str] = []
        at, known = 0, self.pairs
        for end, length in self.automaton.iter_long(text):
            if end - length + 1 != at:
                break
            piece = text[at : end + 1]
            if taken and not (known.get((taken[-1], piece)) or self.compatible(taken[-1], piece)):
                break
            taken.append(piece)
            at = end + 1
        return taken if at == len(text) else self.backtrack(text, taken, at)

    def longest(self, text: str, at: int) -> str:
        piece = text[at : at + max(1, self.automaton.longest_prefix(text[at : at + self.widest]))]
        while len(piece) > 1 and piece not in self.automaton:
            piece = piece[:-1]
        return piece

    def backtrack(self, text: str, taken: list[str], at: int) -> list[str]:
        """Go on from the pieces ``taken`` up to ``at``, going back where nothing fits."""
        n, known, shorter = len(text), self.pairs, self.shorter
        failed = bytearray(n // 8 + 1)
        piece: str | None = self.longest(text, at)
        while True:
            last = taken[-1] if taken else None
            while piece is not None:
                end = at + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (
                    last is None or known.get((last, piece)) or self.compatible(last, piece)
                ):
                    break
                piece = shorter.get(piece)
            if piece is not None:
                taken.append(piece)
                at = end
                if at == n:
                    return taken
                piece = self.longest(text, at)
            else:
                failed[at >> 3] |= 1 << (at & 7)
                piece = taken.pop()
                at -= len(piece)
                piece = shorter.get(piece)

    def word_ids(self, word: str) -> list[int]:
        pieces = self.segment(word)
        try:
            return [self.ids[p] for p in pieces]
        except KeyError:
            spelled = self.vocabulary.byte_ids
            return [
                i for p in pieces for i in ([self.ids[p]] if p in self.ids else [spelled[b] for b in p.encode("utf-8")])
            ]

    def split(self, text: str) -> list[str]:
        """The text with its space marks, cut where no merge can reach across."""
        if not text:
            return []
        if not (self.words_apart and self.lines_apart):
            return [SPACE + text.replace(" ", SPACE)]
        words: list[str] = []
        for number, line in enumerate(text.split("\n")):
            if number:
                words.append("\n")
            if "  " in line or SPACE in line or line[:1] == " " or line[-1:] == " ":
                run = not number
                for part in line.replace(" ", SPACE).split(SPACE):
                    if part:
                        words.append(SPACE * run + part)
                        run = 0
                    run += 1
                if run > 1:
                    words.append(SPACE * (run - 1))
            else:
                parts = line.split(" ")
                if not number:
                    words.append(SPACE + parts[0])
                elif parts[0]:
                    words.append(parts[0])
                words += [SPACE + p for p in parts[1:]]
        return words

    def encode(self, text: str) -> list[int]:
        out = [i for word in self.split(text) for i in self.word_ids(word)]
        out.append(self.vocabulary.end_id)
        return out

    def plain(self, ids: list[int]) -> str:
        """Text of pieces and bytes; each ill-formed byte becomes U+FFFD, control ids nothing."""
        text_of, byte_of = self.vocabulary.text, self.vocabulary.byte_of
        try:
            return "".join([text_of[i] for i in ids])
        except KeyError:
            pass
        out: list[str] = []
        pending = bytearray()
        for i in ids:
            if i in byte_of:
                pending.append(byte_of[i])
                continue
            out.append(pending.decode("utf-8", "replace"))
            pending.clear()
            out.append(text_of.get(i, ""))
        out.append(pending.decode("utf-8", "replace"))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        """Inverse of ``encode``: the space mark that it puts in front goes."""
        text = self.plain(ids)
        return text[1:] if text.startswith(" ") else text

    def told(self, word: str) -> str:
        """The ids of one word as text; remembered if the word is short and its ids decode to it."""
        known = self.older.get(word)
        if known is None:
            joins = self.joins
            cuts = [i for i in range(1, len(word)) if word[i - 1 : i + 1] not in joins]
            if cuts:  # no piece holds these two characters in a row
                newer = self.newer.get
                parts = [word[i:j] for i, j in zip([0, *cuts], [*cuts, len(word)])]
                known = " ".join([newer(p) or self.told(p) for p in parts])
            else:
                known = " ".join(map(str, self.word_ids(word)))
            if len(word) > REMEMBERED_LENGTH or self.plain(list(map(int, known.split()))) != word.replace(SPACE, " "):
                return known
        if len(self.newer) >= REMEMBERED_WORDS:
            self.older, self.newer = self.newer, {}
        self.newer[word] = known
        return known

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids as text, and of the decoded text."""
        known = self.newer.get
        parts: list[str] = []
        spelled: list[str] = []  # what the ids decode to
        for word in self.split(text):
            ids = known(word)
            if ids is not None:
                spelled.append(word.replace(SPACE, " "))
            else:
                ids = self.told(word)
                spelled.append(self.plain(list(map(int, ids.split()))))
            parts.append(ids)
        parts.append(str(self.vocabulary.end_id))
        joined = " ".join(parts)
        decoded = "".join(spelled)
        decoded = decoded[1:] if decoded.startswith(" ") else decoded
        return (
            joined.count(" ") + 1,
            hashlib.sha256(joined.encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MAX_MODEL_BYTES + 1)
    if len(model) > MAX_MODEL_BYTES:
        raise ValueError(f"the model file is larger than {MAX_MODEL_BYTES} bytes")
    return model


_ENCODERS: dict[int, Encoder] = {}


def _encoder(model: bytes) -> Encoder:
    """One encoder for each model and Python worker."""
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def encode_column(text: Column, model: bytes) -> Column:
    """``array<int>`` of ids, end id included; a null text encodes as an empty one."""

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(model)
        for texts in batches:
            yield pd.Series([encoder.encode(t or "") for t in texts], dtype=object)

    return encode(text)


def decode_column(ids: Column, model: bytes) -> Column:
    """Text of an ``array<int>``; null for null."""

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(model)
        for lists in batches:
            yield pd.Series([None if x is None else encoder.decode([int(i) for i in x]) for x in lists], dtype=object)

    return decode(ids)


def encode_digests(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document.

    The ids and texts themselves stay in the task. A null text counts as
    empty: one id, the end. Repeated rows give repeated rows; columns other
    than ``doc_id, text`` are not read.
    """
    prepare(docs.sparkSession)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(model)
        for texts in batches:
            rows = [encoder.digests(t or "") for t in texts]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    told = docs.select("doc_id", digest(F.col("text")).alias("told"))
    return told.select("doc_id", "told.n_tokens", "told.ids_sha256", "told.decoded_sha256")
