"""The corpus pipeline: documents to training tokens, in five written stages.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``, further columns included, whatever
their names. An empty table passes through every stage as an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillcast.llm import bagminhash, mixing, pii, piece, quality
from tillcast.llm.common import stored, table
from tillcast.llm.queries import piece_model


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or are outliers go. A null, empty or short text fails
    the base rules; null languages and sources are values of their own; repeated rows have one
    verdict; texts of any length count whole."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, that with the smallest id
    (a null id counts as the largest; of repeated rows one). Texts without words all stay."""
    return bagminhash.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in every whole text, and ``n_chars`` follows. A null
    text stays null; equal texts stay equal; no row goes."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, one row for each pass that the mix makes over them. A null
    text has no words and is not taken; a null source is a source of its own; documents at one
    position are ordered by id."""
    return mixing.training_order(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of each document as digests. A null text counts as empty: the end id
    alone. Repeated rows give repeated rows."""
    return piece.encode_digests(docs, piece_model())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", tokens),
]

# Covariance estimates, boosted trees and merges are no SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"pipeline_{number}")
    return docs


QUERIES = {"pipeline": run}
