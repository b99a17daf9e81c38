"""Personal data by candidate generation and gradient boosting, in SQL functions only.

Strict patterns with checks (octets, check digits, number of digits) give the
base spans, which always stay. High-recall generators propose more spans that
may overlap them and one another: runs of digits that failed a check, numbers
without country code, addresses and hosts spelled out to avoid being found.
Boosted trees over format and context features score the proposals, and those
above the calibrated threshold of their kind are added where they overlap
nothing kept.

The trees are trained without labels of people: base spans, and base spans in
the disguises that the generators look for, are positive; proposals that fail
their checks are negative. They are fitted on the candidates of all documents, those
with equal features as one weighted row, with a threshold for each kind at which
the held-out precision reaches ``precision``. The fitted trees become one SQL
expression, so a second scan finds the spans without shuffle and without Python.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import keep_row, stored

KINDS = ("email", "ip", "card", "phone")
TREES = 15
DEPTH = 4
PRECISION = 0.995
CONTEXT = 24
CHUNK = 64

# The contract's patterns. Possessive forms and the look-behinds match the same
# spans (a run that fails from its first character fails from every other) in
# linear time. \G allows a start right after the match before.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Texts without this cannot hold a match.
NEEDED = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"),
    "phone": lambda t: F.contains(t, F.lit("+")),
}
GENERATORS = {
    # me (at) site.org, me [at] site (dot) org, me at site dot org
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:\x20?[(\[](?:at|@)[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|\.)[)\]]\x20?)[A-Za-z0-9-]++)++"
    r"|\x20at\x20[A-Za-z0-9-]++(?:\x20dot\x20[A-Za-z0-9-]++)++)",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:[(\[](?:dot|\.)[)\]][0-9]{1,3}){3}(?![0-9])",
    # 16 to 19 digits in groups of four, also where more groups of digits follow or precede
    "card": r"(?<![0-9])[0-9]{4}(?:[._/\x20-][0-9]{4}){3}(?:[._/\x20-]?[0-9]{1,3})?(?![0-9])",
    # no piece of a longer number: no group of digits beside it
    "phone": r"(?<![0-9+])(?<![0-9][\x20.-])(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-][0-9]{2,4}[\x20.-][0-9]{3,4}(?![\x20.-]?[0-9])",
}
GENERATOR_NEEDED = {
    "email": lambda t: t.rlike(r"[(\[](?:at|@)[)\]]|\x20dot\x20"),
    "ip": lambda t: t.rlike(r"[0-9][(\[](?:dot|\.)[)\]][0-9]"),
    "card": lambda t: t.rlike(r"[0-9]{4}[._/\x20-][0-9]{4}"),
    "phone": lambda t: t.rlike(r"[0-9]\)?[\x20.-][0-9]{2}"),
}
# A base span in the forms its kind's generator looks for.
DISGUISES: dict[str, tuple[Callable[[Column], Column], ...]] = {
    "email": (
        lambda m: F.regexp_replace(m, "@", "(at)"),
        lambda m: F.regexp_replace(m, "@", " (at) "),
        lambda m: F.regexp_replace(F.regexp_replace(m, "@", " at "), r"\.(?=[^@]*$)", " dot "),
    ),
    "ip": (lambda m: F.regexp_replace(m, r"\.", "[.]"),),
    "card": (lambda m: F.regexp_replace(F.regexp_replace(m, "[^0-9]", ""), "([0-9]{4})(?=[0-9])", "$1."),),
    "phone": (lambda m: F.regexp_replace(m, r"^\+[0-9]{1,3}[\x20.-]*", ""),),
}
# The same spans where what stands before them says that they are something else.
OTHER_CONTEXTS = ("order number ", "invoice no. ", "version ", "serial id: ", "isbn ", "total ")
UNSEEN_THRESHOLD = 0.5  # of a kind without held-out candidates
STRICT_THRESHOLD = 0.95  # of a kind whose held-out candidates never reach the precision
MARK = "\x01"
SPAN = "struct<s:int,e:int,m:string>"
_NONE = f"array<{SPAN}>"


def running(df: DataFrame, values: str, out: str, combine: Callable[[Column, Column], Column]) -> DataFrame:
    """Adds ``out``: the inclusive running value of an array of non-negative numbers.

    Works in chunks, so an array of n costs about n * CHUNK steps, not n * n.
    """
    whole = (F.greatest(F.size(values), F.lit(1)) - 1) / CHUNK
    chunks = F.transform(F.sequence(F.lit(0), F.floor(whole).cast("int")), lambda c: F.slice(values, c * CHUNK + 1, CHUNK))
    zero = F.array(F.lit(0).cast("int"))

    def push(done: Column, x: Column) -> Column:
        return F.concat(done, F.array(combine(F.element_at(done, -1), x)))

    df = df.withColumn(f"{out}_in", F.transform(chunks, lambda c: F.aggregate(c, zero, push)))
    df = df.withColumn(f"{out}_at", F.aggregate(f"{out}_in", zero, lambda done, c: push(done, F.element_at(c, -1))))
    shifted = F.transform(
        f"{out}_in",
        lambda c, i: F.transform(F.slice(c, F.lit(2), F.lit(CHUNK)), lambda x: combine(F.get(f"{out}_at", i), x)),
    )
    return df.withColumn(out, F.flatten(shifted)).drop(f"{out}_in", f"{out}_at")


def find_spans(df: DataFrame, text: str, pattern: str, needed: Callable[[Column], Column], out: str) -> DataFrame:
    """Adds ``out``: all matches as (start, end, match), in code points, end exclusive.

    The matches are marked in the text and the text cut at the marks; lengths
    of the pieces add up to the positions. A mark character in the text itself
    was exchanged before for one that no pattern holds either.
    """
    marked = F.regexp_replace(F.col(text), pattern, f"{MARK}$0{MARK}")
    df = df.withColumn(f"{out}_p", F.when(needed(F.col(text)), F.split(marked, MARK, -1)))
    df = df.withColumn(f"{out}_l", F.when(F.size(f"{out}_p") > 1, F.transform(f"{out}_p", F.length)))
    df = running(df, f"{out}_l", f"{out}_c", lambda a, b: (a + b).cast("int"))
    cut = F.transform(
        F.sequence(F.lit(1), F.size(f"{out}_p") - 1, F.lit(2)),
        lambda i: F.struct(
            F.get(f"{out}_c", i - 1).alias("s"), F.get(f"{out}_c", i).alias("e"), F.get(f"{out}_p", i).alias("m")
        ),
    )
    found = F.when(F.size(f"{out}_p") > 1, cut).otherwise(F.array()).cast(_NONE)
    return df.withColumn(out, found).drop(f"{out}_p", f"{out}_l", f"{out}_c")


def digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the check-digit rule."""

    def doubled(x: Column, i: Column) -> Column:
        value = x.cast("int")
        return F.when(i % 2 == 0, value).otherwise(F.when(value > 4, value * 2 - 9).otherwise(value * 2))

    places = F.transform(F.filter(F.split(F.reverse(number), ""), lambda x: x != ""), doubled)
    return F.aggregate(places, F.lit(0), lambda a, b: a + b) % 10 == 0


def octets(m: Column) -> Column:
    def small(part: Column) -> Column:
        bare = F.regexp_replace(part, "^0+", "")
        return F.when(F.length(bare) <= 3, F.concat(F.lit("0"), bare).cast("int") <= 255).otherwise(False)

    return F.forall(F.filter(F.split(m, "[^0-9]+"), lambda p: p != ""), small)


VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": octets,
    "card": lambda m: F.when(F.length(digits(m)).between(16, 19), luhn(digits(m))).otherwise(False),
    "phone": lambda m: F.length(digits(m)).between(8, 15),
}


def base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``clean`` and, for each kind, ``b_kind`` (base spans) and ``f_kind`` (matches that failed)."""
    df = df.withColumn("clean", F.translate(F.coalesce(F.col(text), F.lit("")), MARK, "\x02"))
    for kind in KINDS:
        df = find_spans(df, "clean", BASE[kind], NEEDED[kind], f"a_{kind}")
        valid = VALID[kind]
        df = df.withColumn(f"b_{kind}", F.filter(f"a_{kind}", lambda x: valid(x["m"])))  # noqa: B023
        df = df.withColumn(f"f_{kind}", F.filter(f"a_{kind}", lambda x: ~valid(x["m"]))).drop(f"a_{kind}")  # noqa: B023
    return df


def _located(spans: str, text: str, kind: int) -> Column:
    """Spans with kind and surroundings, as the features need them."""
    start = lambda x: F.greatest(x["s"] - CONTEXT, F.lit(0))
    return F.transform(
        spans,
        lambda x: F.struct(
            F.lit(kind).alias("k"),
            x["s"].alias("s"),
            x["e"].alias("e"),
            x["m"].alias("m"),
            F.substring(F.col(text), start(x) + 1, x["s"] - start(x)).alias("before"),
            F.substring(F.col(text), x["e"] + 1, F.lit(CONTEXT)).alias("after"),
        ),
    )


def proposals(df: DataFrame) -> DataFrame:
    """Adds ``proposed``: generated candidates that overlap no base span."""
    lists = []
    for number, kind in enumerate(KINDS):
        df = find_spans(df, "clean", GENERATORS[kind], GENERATOR_NEEDED[kind], f"g_{kind}")
        lists += [_located(f"g_{kind}", "clean", number), _located(f"f_{kind}", "clean", number)]
    df = df.withColumn("all_proposed", F.concat(*lists))
    df = df.withColumn("all_base", F.concat(*[F.col(f"b_{k}") for k in KINDS]))
    df = df.withColumn(
        "proposed", F.filter("all_proposed", lambda c: ~F.exists("all_base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    )
    # A number inside one that passes the check of a card is a piece of it.
    df = df.withColumn("cards", F.filter("proposed", lambda c: F.when(c["k"] == 2, _plausible(c)).otherwise(False)))
    piece = lambda c: F.exists("cards", lambda d: (c["k"] != 2) & (d["s"] < c["e"]) & (c["s"] < d["e"]))
    return df.withColumn("proposed", F.filter("proposed", lambda c: ~piece(c))).drop(
        "all_proposed", "all_base", "cards", *[f"g_{k}" for k in KINDS]
    )


def features(c: Column) -> list[Column]:
    """Format and context features of one located candidate."""
    m, d = c["m"], digits(c["m"])
    number = lambda condition: condition.cast("double")
    last, following = F.substring(c["before"], -1, 1), F.substring(c["after"], 1, 1)
    groups = F.size(F.filter(F.split(m, "[^0-9]+"), lambda p: p != ""))
    return [
        *[number(c["k"] == k) for k in range(len(KINDS))],
        F.length(m).cast("double"),
        F.length(d).cast("double"),
        F.length(F.regexp_replace(m, "[^A-Za-z]", "")).cast("double"),
        groups.cast("double"),
        number(m.rlike(r"[().\x20-]")),
        number(F.contains(m, F.lit("+"))),
        number(m.rlike(r"[@(\[]")),
        number(F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False)),
        number(octets(m)),
        number(last.rlike("[A-Za-z0-9]")),
        number(following.rlike("[A-Za-z0-9]")),
        number(c["before"].rlike(r"[0-9][\x20.-]{0,2}$")),
        number(c["after"].rlike(r"^[\x20.-]{0,2}[0-9]")),
        number(c["before"].rlike(r"(?i)(?:tel|phone|call|fax|mail|contact|card|ip|host)[^A-Za-z]*$")),
        number(c["before"].rlike(r"(?i)(?:token|key|id|no|number|total|version|isbn)[^A-Za-z]*$")),
    ]


@dataclass(frozen=True)
class Trees:
    """Boosted trees as nested ``(feature, threshold, left, right)`` with leaves, and thresholds by kind."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def score(self, x: list[Column]) -> Column:
        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(x[feature] <= threshold, value(left)).otherwise(value(right))

        margin = F.lit(0.0)
        for weight, tree in zip(self.weights, self.trees):
            margin = margin + F.lit(weight) * value(tree)
        return 1 / (1 + F.exp(-2 * margin))


def parse_tree(text: str):
    """A tree from MLlib's description of it."""
    lines = [x.strip() for x in text.splitlines()]
    lines = [x for x in lines if x.startswith(("If", "Else", "Predict"))]
    at = 0

    def node():
        nonlocal at
        line = lines[at]
        at += 1
        if line.startswith("Predict"):
            return float(line.split(":", 1)[1])
        feature, threshold = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
        left = node()
        at += 1  # its Else
        return int(feature), float(threshold), left, node()

    return node()


def _disguised(form: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda c: c.withField("m", form(c["m"]))


def _candidates(found: DataFrame) -> DataFrame:
    """``label, k, m, before, after, n``: the training candidates of ``proposals``' rows, equal ones as one.

    Ordinary words, in a candidate's place what none of the kinds looks like,
    have kind -1 here: each stands for one candidate of every kind.
    """
    positive, disguised = [], []
    for number, kind in enumerate(KINDS):
        located = _located(f"b_{kind}", "clean", number)
        positive.append(located)
        disguised += [F.transform(located, _disguised(form)) for form in DISGUISES[kind]]
    contexts = F.array(*[F.lit(c) for c in OTHER_CONTEXTS])
    of_other = lambda c: c.withField("before", F.get(contexts, F.pmod(F.xxhash64(c["m"]), F.lit(len(OTHER_CONTEXTS))).cast("int")))
    numbers = F.filter("_disguised", lambda c: c["k"].isin(1, 3))  # a card's check digit outweighs its context
    word = F.regexp_extract("clean", r"(?:^|[\x20\x09-\x0D])([A-Za-z]{3}[^\x20\x09-\x0D]*+)", 1)
    plain = F.when(
        word != "", F.array(F.struct(F.lit(-1).alias("k"), word.alias("m"), F.lit("").alias("before"), F.lit(" ").alias("after")))
    ).otherwise(F.array())

    def labelled(candidates: Column, label: float) -> Column:
        told = lambda c: F.struct(
            F.lit(label).alias("label"), c["k"].alias("k"), c["m"].alias("m"), c["before"].alias("before"), c["after"].alias("after")
        )
        return F.transform(candidates, told)

    found = found.withColumn("_disguised", F.concat(*disguised))
    every = F.concat(
        *[labelled(p, 1.0) for p in positive],
        labelled(F.col("_disguised"), 1.0),
        labelled(F.filter("proposed", lambda c: ~_plausible(c)), 0.0),
        labelled(F.transform(numbers, of_other), 0.0),
        labelled(plain, 0.0),
    )
    each = found.select(F.explode(every).alias("c")).select("c.*")
    return each.groupBy("label", "k", "m", "before", "after").agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, precision: float = PRECISION) -> Trees | None:
    """Fit trees and thresholds on the candidates of all texts; None where they hold no positive or
    no negative candidate.

    Candidates with equal features are one row that weighs as many.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array

    held = _candidates(proposals(base_spans(docs.select("text"))))
    kinds = F.when(F.col("k") < 0, F.array(*[F.lit(k) for k in range(len(KINDS))])).otherwise(F.array("k"))
    held = held.withColumn("k", F.explode(kinds))
    c = F.struct("k", "m", "before", "after")
    table = held.select("label", "k", "n", F.array(*features(c)).alias("x"))
    table = stored(table.groupBy("label", "k", "x").agg(F.sum("n").cast("double").alias("n")), "pii_training")
    present = {r["label"] for r in table.select("label").distinct().collect()}
    if present != {0.0, 1.0}:
        return None
    held_out = F.pmod(F.xxhash64("x", F.lit("held out")), F.lit(4)) == 0
    vectors = table.select("label", "k", "n", array_to_vector("x").alias("features"), held_out.alias("held_out"))
    fitted = vectors.where(~F.col("held_out"))
    if fitted.select("label").distinct().count() < 2:
        fitted = vectors
    # The learner looks for split points in a sample of max(maxBins^2, 10000) rows: let that be all.
    bins = max(32, math.isqrt(fitted.count()) + 1)
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=7, stepSize=0.2, weightCol="n", maxBins=bins).fit(fitted)
    scored = model.transform(vectors.where("held_out")).select("k", "label", "n", vector_to_array("probability")[1].alias("p"))
    binned = scored.groupBy("k", F.floor(F.col("p") * 200).cast("int").alias("bin")).agg(
        F.sum(F.col("label") * F.col("n")).alias("yes"), F.sum("n").alias("n")
    )
    by_kind: dict[int, list] = {}
    for r in binned.collect():  # at most 201 bins a kind
        by_kind.setdefault(r["k"], []).append((r["bin"], r["yes"], r["n"]))
    thresholds = []
    for number in range(len(KINDS)):
        # Half-way between the last bin that holds the precision and the first that breaks it.
        best, good, yes, n = UNSEEN_THRESHOLD, None, 0.0, 0
        for bin_, y, m in sorted(by_kind.get(number, []), reverse=True):
            yes, n = yes + y, n + m
            if yes < precision * n:
                best = max(best, STRICT_THRESHOLD if good is None else (good + bin_ + 1) / 400)
                break
            good = bin_
        thresholds.append(best)
    trees = tuple(parse_tree(t.toDebugString) for t in model.trees)
    return Trees(trees, tuple(float(w) for w in model.treeWeights), tuple(thresholds))


def _plausible(c: Column) -> Column:
    """Whether a proposal passes its kind's checks, whatever its punctuation."""
    d, groups = digits(c["m"]), F.size(F.filter(F.split(c["m"], "[^0-9]+"), lambda p: p != ""))
    inside = c["before"].rlike(r"[0-9][\x20.-]?$") | c["after"].rlike(r"^[\x20.-]?[0-9]")
    return (
        F.when(c["k"] == 0, F.lit(True))
        .when(c["k"] == 1, octets(c["m"]))
        .when(c["k"] == 2, F.when(F.length(d).between(16, 19), luhn(d)).otherwise(False))
        .otherwise(F.length(d).between(8, 15) & (groups >= 3) & ~inside)
    )


def detect(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), trees: Trees | None = None) -> DataFrame:
    """``keep`` columns, ``b_kind`` base spans and ``s_kind`` all spans of each kind.

    ``docs`` has ``doc_id, text``. A null or empty text has no spans; texts of
    any length are searched whole; equal texts, so repeated rows too, get equal
    spans; an empty table gives no rows; other columns are not read, so they may
    have any name. Of added spans that overlap, the first stays, then the longest,
    then the first kind; a number inside a card is no span of its own. The trees
    are fitted on the table itself unless given.
    """
    trees = trees if trees is not None else train(docs)
    found = proposals(base_spans(docs.select(*keep, "text")))
    if trees is None:
        chosen = F.filter("proposed", lambda c: F.lit(False))
    else:
        limit = F.array(*[F.lit(t) for t in trees.thresholds])
        found = found.withColumn(
            "scored",
            F.transform(
                "proposed",
                lambda c: F.struct(F.transform(F.array(F.array(*features(c))), lambda x: trees.score([x[i] for i in range(19)]))[0].alias("p"), c.alias("c")),
            ),
        )
        chosen = F.transform(F.filter("scored", lambda x: x["p"] >= F.get(limit, x["c"]["k"])), lambda x: x["c"])
    found = found.withColumn("chosen", chosen)
    # Of added spans that overlap, the first stays; of those that start together, the longest.
    better = lambda a, b: (a["s"] < b["e"]) & (b["s"] < a["e"]) & (
        (b["s"] < a["s"]) | ((b["s"] == a["s"]) & ((b["e"] > a["e"]) | ((b["e"] == a["e"]) & (b["k"] < a["k"]))))
    )
    found = found.withColumn("added", F.filter("chosen", lambda a: ~F.exists("chosen", lambda b: better(a, b))))
    for number, kind in enumerate(KINDS):
        own = F.transform(
            F.filter("added", _of_kind(number)), lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["m"].alias("m"))
        )
        found = found.withColumn(f"s_{kind}", F.array_sort(F.array_distinct(F.concat(f"b_{kind}", own))))
    return found.select(*keep, "clean", *[f"b_{k}" for k in KINDS], *[f"s_{k}" for k in KINDS])


def _of_kind(number: int) -> Callable[[Column], Column]:
    return lambda c: c["k"] == number


def _named(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))


def _tagged(kind: str) -> Callable[[Column], Column]:
    return lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(f"[{kind.upper()}]").alias("tag"))


def _listed(prefix: str) -> Column:
    """``kind:start:end`` of all spans, by kind and start, joined by commas."""
    return F.array_join(F.concat(*[F.transform(f"{prefix}_{k}", _named(k)) for k in KINDS]), ",")


def span_report(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = detect(docs)
    counts = [F.size(f"b_{k}").cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(_listed("b"), 256).alias("base_sha256"), _listed("s").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in brackets.

    Keeps the columns of ``docs``; ``n_chars``, where there, follows the text.
    A null text stays null. Of overlapping spans the first one's kind stands
    for the whole stretch.
    """
    packed = keep_row(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    found = detect(packed, keep=("row", "doc_id"))
    tagged = [F.transform(f"s_{k}", _tagged(k)) for k in KINDS]
    found = found.select("row", "clean", F.array_sort(F.concat(*tagged)).alias("spans"))
    found = found.withColumn("ends", F.transform("spans", lambda x: x["e"]))
    found = running(found, "ends", "far", lambda a, b: F.greatest(a, b))
    text = F.col("row.text")

    def piece(x: Column, i: Column) -> Column:
        start = F.when(i > 0, F.get("far", i - 1)).otherwise(0)
        return F.when(x["s"] >= start, F.concat(F.substring(text, start + 1, x["s"] - start), x["tag"])).otherwise("")

    last = F.get("far", F.size("far") - 1)
    rest = F.substring(text, last + 1, F.length(text))
    new = F.when(F.size("spans") > 0, F.concat(F.array_join(F.transform("spans", piece), ""), rest)).otherwise(text)
    found = found.select("row", new.alias("new_text"))
    fields = {"text": F.col("new_text"), "n_chars": F.coalesce(F.length("new_text").cast("long"), F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return found.select(*[(fields[c] if fields.get(c) is not None else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
