"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training sums n-gram counts per language over all eligible rows: each task
adds up dense count vectors for the languages it meets and hands on their
non-zero cells, which Spark sums. The matrix of log probabilities (languages x
buckets) is sent to the tasks in models of a bounded number of cells (one, up to
256 languages), and each text's sparse count vector is multiplied with each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, remainder_is, stored

ORDERS = (1, 2, 3)
BITS = 14
MAX_CELLS = 1 << 22  # of one model, as it is collected and sent
MAX_LANGUAGES = 1 << 14
SMOOTHING = 0.5
UNKNOWN = "und"
# Code points are read in blocks, so the working arrays of one very long text
# stay small; blocks overlap so that no n-gram is lost.
BLOCK = 1 << 16

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Which code points are letters, found once for each worker."""
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000))
    return _LETTERS[0]


def ngram_buckets(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text's n-grams and how often each occurs.

    Lower case; every run of other characters than letters counts as one
    space. Empty for a text without a letter.
    """
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    code = np.where(letter, points, np.uint32(32)).astype(np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    code = np.concatenate(([np.uint64(32)], code[keep], [np.uint64(32)]))
    total = np.zeros(1 << bits, dtype=np.int64) if len(code) > 4 * BLOCK else None
    hashes = []
    for start in range(0, len(code), BLOCK):
        block = code[start : start + BLOCK + max(ORDERS) - 1]
        own = min(BLOCK, len(code) - start)
        rolling = np.zeros(len(block), dtype=np.uint64)
        for n in range(1, max(ORDERS) + 1):
            size = len(block) - n + 1
            if size <= 0:
                break
            rolling = rolling[:size] * np.uint64(0x100000001B3) + block[n - 1 :] + np.uint64(n)
            if n in ORDERS:
                mixed = rolling[: min(own, size)] * np.uint64(0x9E3779B97F4A7C15)
                hashes.append((mixed >> np.uint64(64 - bits)).astype(np.int64))
        if total is not None:
            for h in hashes:
                total += np.bincount(h, minlength=1 << bits)
            hashes = []
    if total is not None:
        buckets = np.flatnonzero(total)
        return buckets, total[buckets]
    return np.unique(np.concatenate(hashes), return_counts=True)


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    log_prior: np.ndarray
    log_probability: np.ndarray  # buckets x languages
    bits: int

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """The most probable of these languages, its log score, and the log of the sum of all
        their scores (minus infinity for a text without a letter)."""
        buckets, counts = ngram_buckets(text, self.bits)
        if not len(buckets) or not self.languages:
            return UNKNOWN, -math.inf, -math.inf
        score = self.log_prior + counts @ self.log_probability[buckets]
        best = int(score.argmax())
        top = float(score[best])
        return self.languages[best], top, top + math.log(float(np.exp(score - top).sum()))


def train(rows: DataFrame, bits: int = BITS, smoothing: float = SMOOTHING, max_cells: int = MAX_CELLS) -> list[LanguageModel]:
    """Fit on ``text, lang`` rows; a null text or language teaches nothing.

    A language has ``2 ** bits`` cells whatever the number of languages. They are
    dealt into models of at most ``max_cells`` cells, the bound of what is
    collected and sent at once; more than ``MAX_LANGUAGES`` values are an error.
    """
    prepare(rows.sparkSession)
    eligible = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    found = eligible.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    priors = {r["lang"]: r["n"] for r in sorted(found, key=lambda r: r["lang"])}
    number = {lang: i for i, lang in enumerate(priors)}

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def told() -> Iterator[pd.DataFrame]:
            for lang, dense in sums.items():
                cells = np.flatnonzero(dense)
                yield pd.DataFrame({"language": number[lang], "bucket": cells, "n": dense[cells]})
            sums.clear()

        for frame in frames:
            for text, lang in zip(frame["text"], frame["lang"]):
                buckets, counts = ngram_buckets(text, bits)
                if lang not in sums:
                    if len(sums) << bits >= max_cells:
                        yield from told()
                    sums[lang] = np.zeros(1 << bits, dtype=np.int64)
                sums[lang][buckets] += counts
        yield from told()

    partial = eligible.mapInPandas(count, "language int, bucket int, n long")
    summed = stored(partial.groupBy("language", "bucket").agg(F.sum("n").alias("n")), "language_cells")
    names, total, width = list(priors), sum(priors.values()), max(1, max_cells >> bits)
    models = []
    for at in range(0, len(names), width):
        held = names[at : at + width]
        cells = summed.where(F.col("language").between(at, at + len(held) - 1)).toPandas()  # at most max_cells rows
        counts = np.zeros((1 << bits, len(held)))
        counts[cells["bucket"].to_numpy(), cells["language"].to_numpy() - at] = cells["n"].to_numpy()
        counts += smoothing
        prior = np.array([priors[lang] for lang in held], dtype=float)
        models.append(LanguageModel(tuple(held), np.log(prior / total), np.log(counts / counts.sum(axis=0)).astype(np.float32), bits))
    return models


def predict_column(text: Column, broadcast) -> Column:
    """``struct<lang_pred, top, log_sum>`` of a text column; ``broadcast`` holds one model."""

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        held = broadcast.value
        for texts in batches:
            yield pd.DataFrame([held.predict(t) for t in texts], columns=["lang_pred", "top", "log_sum"])

    return F.pandas_udf(predict, "lang_pred string, top double, log_sum double")(text)


def identify(docs: DataFrame, max_cells: int = MAX_CELLS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``doc_id, text, lang``.

    Learns from the rows whose crc32 of the id leaves another remainder than 2
    by 4; a null id counts as not held out. ``lang_pred`` is ``und`` with score
    0 for a null text, a text without a letter, and when no language could be
    learned (so for every row of a table without labelled texts); an empty
    table gives no rows. Equal texts get equal answers; languages that tie go
    to the first by name. Texts of any length count whole. Other columns are
    not read, so they may have any name.
    """
    held_out = remainder_is(F.col("doc_id"), 4, 2)
    models = train(docs.where(~held_out), max_cells=max_cells)
    told = docs.select("doc_id", held_out.alias("held_out"), "text")
    for i, model in enumerate(models):
        told = told.withColumn(f"p{i}", predict_column(F.col("text"), docs.sparkSession.sparkContext.broadcast(model)))
    if not models:
        return told.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    # The first model with the largest score has the language; the sums of all models make the score a share.
    answers = F.array(*[F.col(f"p{i}") for i in range(len(models))])
    told = told.select("doc_id", "held_out", answers.alias("p")).withColumn("top", F.array_max(F.transform("p", lambda m: m["top"])))
    first = F.filter("p", lambda m: m["top"] == F.col("top"))[0]
    above = F.aggregate("p", F.lit(0.0), lambda a, m: a + F.exp(m["log_sum"] - F.col("top")))
    lettered = F.col("top") > F.lit(-math.inf)
    return told.select(
        "doc_id", "held_out", F.when(lettered, first["lang_pred"]).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(lettered, 1 / above).otherwise(F.lit(0.0)).alias("score"),
    )
