"""Ranked lexical search, reversed: the documents stream through an index of the items.

The items (queries) are few beside the documents, so the inverted index is
built over the items' terms: term -> items that hold it, with counts. It is
dealt into blocks of at most ``MAX_INDEX_BYTES`` (or one item, if a single item
is larger), and each block is sent to all tasks.

For each block a first pass cuts every text into terms once and keeps, for each
document, its length and the counts of those terms that the block's items hold.
Document frequencies, the number of documents and their total length are sums
over that written table. The second pass scores its rows against the index and
updates one bounded heap an item; a task hands on its heaps' rows, and an
item's best of all tasks are the first of those.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, stored

TOP = 10
MAX_INDEX_BYTES = 32 << 20
PAIRS = 1 << 20  # (document, item) sums and (term, item) products held at once
_POSTING_BYTES = 24  # of one term of one item beside the term's own bytes
_EXACT = 1 << 53

# Everything in ASCII but letters and digits parts terms; capitals become small.
_TABLE = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c >= 128 or chr(c).isalnum() else 32 for c in range(256)
)

_FOUND = "item long, item_id long, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8, repeats included, in order."""
    return text.translate(_TABLE).split()


def weight(n_docs: int, df: int) -> int:
    """The weight of a term held by ``df`` of ``n_docs`` documents."""
    return math.floor(1000.0 * math.log((2.0 * n_docs + 2.0) / (2.0 * df + 1.0)))


class Index:
    """The inverted index over one block of items."""

    def __init__(self, postings: list[tuple[int, int | None, bytes, int]]):
        numbers: dict[int, int] = {}
        self.of_term: dict[bytes, int] = {}
        rows = []
        self.items: list[tuple[int, int | None]] = []
        for item, item_id, term, count in postings:
            if item not in numbers:
                numbers[item] = len(numbers)
                self.items.append((item, item_id))
            rows.append((self.of_term.setdefault(term, len(self.of_term)), numbers[item], count))
        rows.sort()
        held = np.array(rows, dtype=np.int64).reshape(len(rows), 3)
        self.item, self.count = held[:, 1].copy(), held[:, 2].copy()
        self.start = np.searchsorted(held[:, 0], np.arange(len(self.of_term) + 1))
        self.most = int(np.bincount(self.item, weights=self.count).max(initial=0))

    def counted(self, text: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a text; those that items hold, with how often each occurs."""
        found = terms(text)
        of_term = self.of_term
        held = [(of_term[t], c) for t, c in Counter(found).items() if t in of_term]
        pairs = np.array(held, dtype=np.int64).reshape(len(held), 2)
        return len(found), pairs[:, 0], pairs[:, 1]


class Heaps:
    """The ``top`` best documents of each item; of equal scores the smaller id, null ids last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.heaps: list[list[tuple[int, bool, int]]] = [[] for _ in range(items)]
        self.least = np.ones(items, dtype=np.int64)  # a score below never enters

    def offer(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, missing: np.ndarray) -> None:
        order = np.lexsort((doc, missing, -score, item))
        item, score, doc, missing = item[order], score[order], doc[order], missing[order]
        first = np.r_[0, np.flatnonzero(np.diff(item)) + 1] if len(item) else np.empty(0, np.int64)
        place = np.arange(len(item)) - np.repeat(first, np.diff(np.r_[first, len(item)]))
        for i, s, d, m in zip(*(x[place < self.top].tolist() for x in (item, score, doc, missing))):
            heap, entry = self.heaps[i], (s, not m, -d)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[i] = heap[0][0]

    def rows(self, items: list[tuple[int, int | None]]) -> pd.DataFrame:
        out = [
            (item, item_id, -d if present else None, s)
            for (item, item_id), heap in zip(items, self.heaps)
            for s, present, d in heap
        ]
        frame = pd.DataFrame(out, columns=["item", "item_id", "doc_id", "score"])
        return frame.astype({"item_id": "Int64", "doc_id": "Int64"})


def score_batch(
    index: Index, weights: np.ndarray, n_docs: int, total: int, frame: pd.DataFrame, heaps: Heaps
) -> None:
    """Score documents given by ``doc_id, n, terms, counts`` and offer them to the heaps."""
    n_items, rows = len(index.items), len(frame)
    held = [np.frombuffer(t, dtype=np.int32) for t in frame["terms"]]
    counts = [np.frombuffer(c, dtype=np.int64) for c in frame["counts"]]
    sizes = frame["n"].to_numpy(dtype=np.int64)
    ids = frame["doc_id"]
    missing = ids.isna().to_numpy()
    doc_ids = ids.fillna(0).to_numpy(dtype=np.int64)
    postings = np.diff(index.start)
    work = np.array([postings[t].sum() for t in held], dtype=np.int64)
    at = 0
    while at < rows:
        to, pairs = at, 0
        while to < rows and (to == at or (pairs + work[to] <= PAIRS and (to + 1 - at) * n_items <= PAIRS)):
            pairs += work[to]
            to += 1
        lengths = np.array([len(t) for t in held[at:to]], dtype=np.int64)
        doc = np.repeat(np.arange(to - at), lengths)
        if len(doc):
            term, tf = np.concatenate(held[at:to]), np.concatenate(counts[at:to])
            m = 100 - 75 + (75 * sizes[at:to] * n_docs) // total
            gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            many = postings[term]
            inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            posting = np.repeat(index.start[term], many) + inside
            cell = np.repeat(doc, many) * n_items + index.item[posting]
            part = np.repeat(gain, many) * index.count[posting]
            if int(gain.max()) * index.most < _EXACT:  # every sum is a whole number that a double holds
                sums = np.bincount(cell, weights=part, minlength=(to - at) * n_items).astype(np.int64)
            else:
                sums = np.zeros((to - at) * n_items, dtype=np.int64)
                np.add.at(sums, cell, part)
            enters = np.flatnonzero(sums >= np.tile(heaps.least, to - at))
            if len(enters):
                of = enters // n_items + at
                heaps.offer(enters % n_items, sums[enters], doc_ids[of], missing[of])
        at = to


def item_terms(items: DataFrame) -> DataFrame:
    """``item, item_id, term, count``: the terms of each item, an item being a row."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [
                (item, item_id, term, count)
                for item, item_id, text in zip(frame["item"], frame["item_id"], frame["text"])
                for term, count in Counter(terms(text)).items()
            ]
            yield pd.DataFrame(rows, columns=["item", "item_id", "term", "count"]).astype({"item_id": "Int64"})

    read = items.select("item_id", "text").where(F.col("text").isNotNull())
    read = read.select(
        F.monotonically_increasing_id().alias("item"),
        F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("binary").alias("text"),
    )
    return read.mapInPandas(cut, "item long, item_id long, term binary, count long")


def _blocks(postings: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """Deal the items into blocks so that a block of several items stays within ``limit`` bytes."""
    sizes = postings.groupBy("item").agg(F.sum(F.octet_length("term") + _POSTING_BYTES).alias("bytes"))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    blocks = -(-total // limit)
    while blocks:
        dealt = F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block")
        over = sizes.groupBy(dealt).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).where("n > 1")
        if blocks == 1 or not over.where(F.col("b") > limit).take(1):
            return postings.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), blocks
        blocks *= 2
    return postings, 0


def _counted(docs: DataFrame, index: Index) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document that holds a term."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                n, held, counts = index.counted(text)
                if n:
                    rows.append((doc_id, n, held.astype(np.int32).tobytes(), counts.tobytes()))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "terms", "counts"]).astype({"doc_id": "Int64"})

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return read.where(F.col("text").isNotNull()).mapInPandas(count, "doc_id long, n long, terms binary, counts binary")


def _frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each of the index's terms occurs."""

    def tally(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(n_terms, dtype=np.int64)
        for frame in frames:
            for held in frame["terms"]:
                df[np.frombuffer(held, dtype=np.int32)] += 1
        seen = np.flatnonzero(df)
        yield pd.DataFrame({"term": seen, "df": df[seen]})

    out = np.zeros(n_terms, dtype=np.int64)
    for row in counted.select("terms").mapInPandas(tally, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[row[0]] = row[1]
    return out


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, max_index_bytes: int = MAX_INDEX_BYTES
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item.

    ``docs`` has ``doc_id, text``, ``items`` has ``item_id, text``; other columns
    are not read, so they may have any name. Texts of any length count whole. A
    null or empty text has no terms: such a document is never found and such an
    item finds nothing. A repeated row is a document (or an item) of its own.
    Equal scores go to the smaller ``doc_id``, null ids last. Empty tables give
    no rows.
    """
    spark = docs.sparkSession
    prepare(spark)
    postings, blocks = _blocks(stored(item_terms(items), "lexical_items"), max_index_bytes)
    found = spark.createDataFrame([], _FOUND)
    n_docs = total = None
    for block in range(blocks):
        # At most ``max_index_bytes``, or the terms of one item.
        held = postings.where(F.col("block") == block).select("item", "item_id", "term", "count").collect()
        if not held:
            continue
        index = Index([(r[0], r[1], bytes(r[2]), r[3]) for r in held])
        counted = stored(_counted(docs, index), "lexical_counts")
        if n_docs is None:
            n_docs, total = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            return found.select("item_id", F.lit(1).alias("rank"), "doc_id", "score")
        weights = np.array([weight(n_docs, int(df)) for df in _frequencies(counted, len(index.of_term))], dtype=np.int64)
        found = found.unionByName(_scored(counted, index, weights, n_docs, total, top))
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def _scored(
    counted: DataFrame, index: Index, weights: np.ndarray, n_docs: int, total: int, top: int
) -> DataFrame:
    def stream(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heaps = Heaps(len(index.items), top)
        for frame in frames:
            score_batch(index, weights, n_docs, total, frame, heaps)
        yield heaps.rows(index.items)

    return counted.mapInPandas(stream, _FOUND)
