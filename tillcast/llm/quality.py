"""Quality rules with robust multivariate outliers per language and source.

Base rules reject short and self-repeating texts. Of the others, each text's
statistics are turned into a vector (logs and shares), and a minimum-covariance-
determinant (MCD) estimate of location and scatter is found for each language
and source; texts at a large Mahalanobis distance go. The scatter of the subset,
times its consistency factor, sets the scale; a small share of the variance over
all rows keeps it regular where most of a group's texts are at one value. A share
of a short text rests on few lines or words, so its sampling variance widens the
scale of that text's own gap.

The MCD runs on the cluster: a concentration step gives every vector its
distance under the current estimates, counts vectors and sums their moments
per (group, distance bin), and takes the lowest bins that hold the chosen
share of the group as the next subset. Bins are a fixed number, so a group
with a third of all rows is one partial aggregation like any other; no group
is ever gathered in a task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import give_back_memory, prepare, stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

FEATURES = ("x_words", "x_word_length", "x_symbols", "x_dup_lines", "x_repeats", "x_upper")
# Share of each feature's variance over all rows that is added to a group's
# scatter, and the least that is added.
RIDGE = 0.01
LEAST_RIDGE = 1e-6
SUBSET = 0.75
STEPS = 3
MIN_GROUP = 200
# Squared distance beyond which a vector is an outlier: the 0.9995 quantile of
# chi-square with six degrees of freedom.
CUTOFF = 24.1
BINS_PER_DOUBLING = 8
FINE = 512  # bins a unit for medians
SALTS = 32  # parts that a group's rows are dealt into where they meet its one row of estimates


def text_statistics(texts: pd.Series) -> pd.DataFrame:
    """The base statistics of whole texts (null counts as empty)."""
    rows = []
    for text in texts:
        if not text:
            rows.append((0, 0, 0, 0, 0, 0, 0, 0))
            continue
        raw = text.encode("utf-8")
        words = raw.split()  # bytes.split cuts at exactly the ASCII white space of the contract
        n = len(words)
        blanks = sum(map(raw.count, (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")))
        lines = [line for line in raw.split(b"\n") if line and not line.isspace()]
        beyond = "".join(_BEYOND_ASCII.findall(text)) if len(raw) > len(text) else ""
        upper = int(_count(raw, _UPPER)) + sum(map(str.isupper, beyond))
        letters = max(1, int(_count(raw, _LETTER)) + sum(map(str.isalpha, beyond)))
        rows.append(
            (
                n,
                len(text) - blanks,
                sum(raw.count(s.encode()) for s in SYMBOLS),
                len(lines) - len(set(lines)),
                _repeated_words(words),
                len(lines),
                upper,
                letters,
            )
        )
    return pd.DataFrame(rows, columns=STATISTICS).astype("int64")


# Capitals and letters are Unicode's: counted as bytes in ASCII, by character beyond it.
_BEYOND_ASCII = re.compile(r"[^\x00-\x7F]+")
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True


def _count(raw: bytes, which: np.ndarray) -> int:
    return which[np.frombuffer(raw, dtype=np.uint8)].sum()


def _repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=n)
    if len(number) == n:
        return 0
    width = len(number)
    pair = ids[:-1] * width + ids[1:]
    if width > 1_000_000:  # keep the product of three within 64 bits
        _, pair = np.unique(pair, return_inverse=True)
    window = pair[:-1] * width + ids[2:]
    order = np.argsort(window, kind="stable")
    ordered = window[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(n - 2, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, dtype=bool)
    for shift in range(3):
        covered[shift : shift + n - 2] |= twice
    return int(covered.sum())


STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters")


def _statistics(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield text_statistics(texts)
    give_back_memory()


def statistic_vector() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1))
    return {
        "x_words": F.log(words.cast("double")),
        "x_word_length": F.log((F.col("word_chars") + 1) / words),
        "x_symbols": F.log1p(F.col("n_symbols") / words),
        "x_dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "x_repeats": F.col("n_repeat_words") / words,
        "x_upper": F.least(F.col("n_upper") / F.greatest(F.col("n_letters"), F.lit(1)), F.lit(1.0)),
    }


def sampling_variance() -> dict[str, Column]:
    """Variance each feature has because a text is a finite sample.

    Counts are taken as Poisson, plus one so that a count of 0 has a variance;
    a repeated window covers three words, hence the 9. Words vary in length by
    about 0.6 of their mean.
    """
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    share = lambda n, of, each=1: each * (F.col(n) + 1) / (of * of)
    return {
        "e_0": F.lit(0.0),
        "e_1": 0.36 / words,
        "e_2": share("n_symbols", words + F.col("n_symbols")),
        "e_3": share("n_dup_lines", F.greatest(F.col("n_lines"), F.lit(1)).cast("double")),
        "e_4": share("n_repeat_words", words, 9),
        "e_5": share("n_upper", F.greatest(F.col("n_letters"), F.lit(1)).cast("double")),
    }


_D = len(FEATURES)
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
_MOMENTS = ["m_n", *[f"m_{i}" for i in range(_D)], *[f"m_{i}_{j}" for i, j in _PAIRS]]
_STATE = [*[f"c_{i}" for i in range(_D)], *[f"s_{i}" for i in range(_D)], *[f"v_{i}_{j}" for i, j in _PAIRS]]


def _moments() -> list[Column]:
    """Count, sums and sums of products of the features, as partial aggregates."""
    x = [F.col(f) for f in FEATURES]
    sums = [F.sum(x[i]).alias(f"m_{i}") for i in range(_D)]
    return [F.count(F.lit(1)).alias("m_n"), *sums, *[F.sum(x[i] * x[j]).alias(f"m_{i}_{j}") for i, j in _PAIRS]]


def consistency(share: float) -> float:
    """What the scatter of the ``share`` of normal vectors nearest the centre is multiplied by."""
    if share >= 1:
        return 1.0

    def below(x: float, terms: int) -> float:  # chi-square with 2 * terms degrees of freedom
        part, total = 1.0, 1.0
        for k in range(1, terms):
            part *= x / 2 / k
            total += part
        return 1 - math.exp(-x / 2) * total

    low, high = 0.0, 200.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle, _D // 2) < share else (low, middle)
    return share / below(low, _D // 2 + 1)


def _variances(vectors: DataFrame) -> list[float]:
    """Variance of each feature over all rows, of which a share is added to each group's scatter."""
    return [v or 0.0 for v in vectors.agg(*[F.var_pop(f) for f in FEATURES]).first()]


def _estimator(variances: list[float]):
    def estimates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Location, variances and inverse scatter of each group from its moments (one row a group)."""
        for frame in frames:
            rows = []
            for group, n_all, *m in frame[["group", "all", *_MOMENTS]].itertuples(index=False):
                n, mean = m[0], np.array(m[1 : _D + 1], dtype=float) / m[0]
                second = np.zeros((_D, _D))
                for (i, j), v in zip(_PAIRS, m[_D + 1 :]):
                    second[i, j] = second[j, i] = v / n
                # Below MIN_GROUP vectors, which only a pool of all rows can have, the share grows.
                share = RIDGE + max(0.0, _D / n_all - _D / MIN_GROUP)
                scatter = (second - np.outer(mean, mean)) * consistency(n / n_all)
                scatter += np.diag(share * np.array(variances) + LEAST_RIDGE)
                inverse = np.linalg.inv(scatter)
                rows.append((group, *mean, *np.diag(scatter), *[inverse[i, j] for i, j in _PAIRS]))
            yield pd.DataFrame(rows, columns=["group", *_STATE])

    return estimates


def _looked_up(rows: DataFrame, key: str, few: DataFrame, of: str, by) -> DataFrame:
    """``rows`` with what ``few`` (one row a key) holds for their key, null if nothing.

    Where the join is a shuffle, a key's rows are spread over ``SALTS`` tasks by a
    hash of ``by`` and its one row is repeated for each.
    """
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*by), F.lit(SALTS)).cast("int"))
    repeated = few.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(repeated, (F.col(key) == F.col(of)) & (F.col("salt") == F.col("of_salt")), "left").drop("salt", "of_salt")


def _with_distance(vectors: DataFrame, state: DataFrame, sampled: bool = False) -> DataFrame:
    """Squared Mahalanobis distance; null where the group has no estimate.

    With ``sampled`` each gap is measured on a scale widened by the text's own
    sampling variance (columns ``e_0`` ...).
    """
    joined = _looked_up(vectors, "group", state.withColumnRenamed("group", "state_group"), "state_group", FEATURES)
    gap = [F.col(f) - F.col(f"c_{i}") for i, f in enumerate(FEATURES)]
    if sampled:
        gap = [g * F.sqrt(F.col(f"s_{i}") / (F.col(f"s_{i}") + F.col(f"e_{i}"))) for i, g in enumerate(gap)]
    joined = joined.withColumns({f"gap_{i}": g for i, g in enumerate(gap)})
    gap = [F.col(f"gap_{i}") for i in range(_D)]
    terms = [(1 if i == j else 2) * gap[i] * gap[j] * F.col(f"v_{i}_{j}") for i, j in _PAIRS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return joined.withColumn("distance2", total).drop("state_group", *_STATE, *[f"gap_{i}" for i in range(_D)])


def _medians(values: DataFrame) -> DataFrame:
    """Median of ``value`` per ``group`` and ``feature``, to the width of a bin."""
    counted = values.groupBy("group", "feature", F.floor(F.col("value") * FINE).alias("bin")).agg(F.count("*").alias("n"))
    by_bin = Window.partitionBy("group", "feature").orderBy("bin")
    upto = counted.withColumn("upto", F.sum("n").over(by_bin)).withColumn(
        "all", F.sum("n").over(Window.partitionBy("group", "feature"))
    )
    half = upto.where(F.col("upto") * 2 >= F.col("all"))
    return half.groupBy("group", "feature").agg(((F.min("bin") + 0.5) / FINE).alias("median"))


def _robust_start(vectors: DataFrame, variances: list[float]) -> DataFrame:
    """First estimates: medians and median absolute deviations, features apart."""
    each = vectors.select(
        "group", F.posexplode(F.array(*[F.col(f) for f in FEATURES])).alias("feature", "value")
    )
    middle = stored(_medians(each), "quality_medians")
    near = middle.groupBy(F.col("group").alias("g")).agg(F.map_from_entries(F.collect_list(F.struct("feature", "median"))).alias("medians"))
    gaps = _looked_up(vectors, "group", near, "g", FEATURES).select(
        "group", F.posexplode(F.array(*[F.abs(F.col(f) - F.col("medians")[i]) for i, f in enumerate(FEATURES)])).alias("feature", "value")
    )
    spread = _medians(gaps)
    both = middle.join(spread.withColumnRenamed("median", "mad"), ["group", "feature"])
    pick = lambda c, i: F.max(F.when(F.col("feature") == i, F.col(c)))
    scatter = [F.pow(pick("mad", i) * 1.4826, 2) + RIDGE * variances[i] + LEAST_RIDGE for i in range(_D)]
    columns = [pick("median", i).alias(f"c_{i}") for i in range(_D)]
    columns += [scatter[i].alias(f"s_{i}") for i in range(_D)]
    for i, j in _PAIRS:
        inverse = 1 / scatter[i] if i == j else F.lit(0.0)
        columns.append(inverse.alias(f"v_{i}_{j}"))
    return stored(both.groupBy("group").agg(*columns), "quality_state")


def robust_estimates(
    vectors: DataFrame, subset: float = SUBSET, steps: int = STEPS, variances: list[float] | None = None
) -> DataFrame:
    """MCD location, variances and inverse scatter per ``group`` of the feature columns."""
    variances = variances or _variances(vectors)
    schema = "group string, " + ", ".join(f"{s} double" for s in _STATE)
    state = _robust_start(vectors, variances)
    up_to = Window.partitionBy("group").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("group")
    for _ in range(steps):
        near = _with_distance(vectors, state)
        doublings = F.log2(F.greatest(F.col("distance2"), F.lit(1e-3)))
        binned = near.withColumn("bin", F.floor(doublings * BINS_PER_DOUBLING).cast("int"))
        by_bin = binned.groupBy("group", "bin").agg(*_moments())
        before = F.coalesce(F.sum("m_n").over(up_to), F.lit(0))
        lowest = by_bin.withColumn("before", before).withColumn("all", F.sum("m_n").over(whole))
        kept = lowest.where(F.col("before") < F.col("all") * F.lit(subset))
        moments = kept.groupBy("group").agg(F.max("all").alias("all"), *[F.sum(m).alias(m) for m in _MOMENTS])
        state = stored(moments.mapInPandas(_estimator(variances), schema), "quality_state")
    return state


def judge(
    docs: DataFrame,
    cutoff: float = CUTOFF,
    subset: float = SUBSET,
    steps: int = STEPS,
    min_group: int = MIN_GROUP,
    carry: bool = False,
) -> DataFrame:
    """``doc_id``, the base statistics, ``base_failed``, ``distance2`` and ``kept``.

    ``docs`` has ``doc_id, text, lang, source``. Estimates are fitted on the
    distinct vectors of the texts that pass the base rules, so copies of a
    text count once and cannot make up a group's majority. A language and
    source with fewer than ``min_group`` such vectors is held against its whole
    language, large sources included, and a language with fewer against all
    rows, so every text that passes the base rules gets a distance.

    Defined results: null or empty text has no words and fails the base rules;
    null language and source are values of their own; equal rows get equal
    verdicts; an empty table gives no rows. With ``carry`` the input row comes
    along as the struct ``row``.
    """
    prepare(docs.sparkSession)
    own = [F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")] if carry else []
    statistics = F.pandas_udf(_statistics, ", ".join(f"{s} long" for s in STATISTICS))
    told = docs.select("doc_id", "lang", "source", statistics(F.col("text")).alias("s"), *own)
    flat = told.select("doc_id", "lang", "source", "s.*", *(["row"] if carry else []))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    flat = flat.withColumn("base_failed", failed).withColumns(statistic_vector() | sampling_variance())
    flat = flat.withColumn("own", F.to_json(F.struct("lang", "source"))).withColumn("language", F.to_json(F.struct("lang")))
    flat = stored(flat.drop("lang", "source"), "quality_statistics")

    distinct = flat.where(~F.col("base_failed")).select("own", "language", *FEATURES).distinct()
    distinct = stored(distinct, "quality_distinct")
    by_language = stored(distinct.drop("own").distinct(), "quality_languages")
    per_own = distinct.groupBy("own", "language").count()
    per_language = by_language.groupBy(F.col("language").alias("in_language")).agg(F.count("*").alias("n_language"))
    named = per_own.join(per_language, F.col("language") == F.col("in_language"))
    group = F.when(F.col("count") >= min_group, F.concat(F.lit("own "), F.col("own")))
    group = group.when(F.col("n_language") >= min_group, F.concat(F.lit("language "), F.col("language"))).otherwise(F.lit("rest"))
    groups = stored(named.select(F.col("own").alias("of"), "language", group.alias("group")), "quality_groups")

    large = groups.where(F.col("group").startswith("own ")).select("of", "group")
    vectors = _looked_up(distinct, "own", large, "of", FEATURES).where(F.col("group").isNotNull()).select("group", *FEATURES)
    pools = groups.where(F.col("group").startswith("language ")).select(F.col("language").alias("of"), "group").distinct()
    in_pools = _looked_up(by_language, "language", pools, "of", FEATURES).where(F.col("group").isNotNull())
    vectors = vectors.unionAll(in_pools.select("group", *FEATURES))
    if not groups.where("group = 'rest'").isEmpty():
        vectors = vectors.unionAll(by_language.select(*FEATURES).distinct().select(F.lit("rest").alias("group"), *FEATURES))
    vectors = stored(vectors, "quality_vectors")
    groups = groups.drop("language")
    state = robust_estimates(vectors, subset, steps, _variances(distinct))
    placed = _looked_up(flat, "own", groups, "of", ["doc_id", *FEATURES])
    measured = _with_distance(placed, state, sampled=True)
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("distance2") > cutoff, F.lit(False))
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return measured.select("doc_id", *columns, kept.alias("kept"), "distance2", *(["row"] if carry else []))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that pass, with their own columns."""
    return judge(docs, carry=True, **settings).where("kept").select("row.*")
