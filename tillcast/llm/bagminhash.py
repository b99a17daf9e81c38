"""Near duplicates by BagMinHash over multisets of word shingles.

A text is the multiset of its shingles of five words; the similarity of two
texts is the weighted Jaccard index of their multisets. BagMinHash gives every
shingle a Poisson process over (time, weight): a point of the process falls on
one of m registers, and each register keeps the earliest point whose weight
lies below the shingle's count. Weights are discretised dyadically, [0, 1),
[1, 2), [2, 4), ...: each interval has a process of its own at the rate of its
length, and where a count ends inside an interval, the points' places in it
decide. Two texts agree in a register with a probability equal to their
similarity. Processes are followed only up to the time at which the registers
are expected to be full, so nearly all shingles cost one hash.

Equal texts are one class from the start. Registers are grouped in bands;
texts that agree in a band are candidates, and candidates are verified on their
exact multisets. First, in each bucket all members are compared with one
centre, the text in the largest company. A pair that shares several buckets is
taken in the first of them. It is spared only if an exact bound says that the
texts are too far: every text has a bitmap of its shingles' hashes, a bit that
one text has and the other lacks stands for a shingle that they do not share,
and so two texts share at most their size less the number of such bits. So a
bucket of thousands of near copies costs about one exact comparison each.

Buckets that then hold several classes hold texts that are alike, by a common
passage for instance, but not near; to compare all with all would take the
square of their number. Their texts meet by rare shingles instead: two texts
this similar share one among the rarest fifth of their shingles, and a common
passage is not rare. Pairs that share no bucket, are of one class, or are too
far by size, bitmap or the places of the shared shingle are spared. So no link
is left out. Classes are the connected parts of the graph of verified links;
the second links join the classes of the first, never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import give_back_memory, keep_row, prepare, released, stored

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 25
ROWS = 5
BITMAP_LONGS = 32  # 2,048 bits: telling for texts of up to some 1,000 shingles, an exact bound for all
AT_A_TIME = 1 << 20  # characters of texts whose signatures are made together
SALT_MEMBERS = 1024  # members of a bucket that meet its centres in one task
SEED = np.uint64(0x5DEECE66D1234567)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input reaches every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _times(n: int) -> np.uint64:
    """The golden constant n times over, in 64 bits."""
    return np.uint64((int(_GOLDEN) * n) & 0xFFFFFFFFFFFFFFFF)


def _unit(x: np.ndarray) -> np.ndarray:
    """Uniform numbers in (0, 1] from hashes."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / (1 << 53))


_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
_POWER = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, dtype=np.uint64), dtype=np.uint64)


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of each word: its bytes' values times powers of an odd number, summed and mixed."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    at = np.flatnonzero(~_BLANK[raw])
    if not len(at):
        return np.empty(0, dtype=np.uint64)
    starts = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
    lengths = np.diff(np.concatenate((starts, [len(at)])))
    place = np.arange(len(at)) - np.repeat(starts, lengths)
    sums = np.add.reduceat(_BYTE[raw[at]] * _POWER[place & 4095] + (place >> 12).astype(np.uint64), starts)
    return _mixed(sums + lengths.astype(np.uint64) * _GOLDEN)


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash of each shingle in order; a text with fewer words is one shingle."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    out = np.full(n, np.uint64(min(len(h), size)))
    for k in range(min(size, len(h))):
        out = _mixed(out * _GOLDEN + h[k : k + n])
    return out


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, owners: int, m: int) -> np.ndarray:
    """BagMinHash registers (earliest times) of ``owners`` multisets at once.

    ``elements``, ``weights`` and ``owner`` list the distinct elements of all
    multisets, their counts, and the multiset each belongs to.
    """
    registers = np.full((owners, m), np.inf)
    size = np.bincount(owner, weights=weights, minlength=owners)
    horizon = m * (np.log(m) + 3.0) / np.maximum(size, 1e-300)
    levels = int(np.ceil(np.log2(weights.max()))) + 1 if len(weights) else 0
    processes = []  # one for each element and dyadic interval that its count reaches into
    for level in range(levels):
        low, high = (0, 1) if level == 0 else (1 << (level - 1), 1 << level)
        reach = np.flatnonzero(weights > low)
        seed = _mixed(elements[reach] + _times(level + 1) + SEED)
        processes.append((reach, seed, float(low), float(high - low)))
    pending = np.ones(owners, dtype=bool)
    while len(weights) and pending.any():
        for reach, seed, low, length in processes:
            own = owner[reach]
            use = pending[own]
            at, state, who = reach[use], seed[use], own[use]
            time, step = np.zeros(len(at)), 0
            while len(at):
                step += 1
                draw = _mixed(state + _times(step))
                time = time - np.log(_unit(draw)) / length
                live = time <= horizon[who]
                at, state, who, time, draw = at[live], state[live], who[live], time[live], draw[live]
                place = _mixed(draw + _M1)
                counts = low + length * _unit(_mixed(place + _M2)) <= weights[at]
                np.minimum.at(registers, (who[counts], (place[counts] % np.uint64(m)).astype(np.int64)), time[counts])
        # Registers still empty need a longer run; the processes repeat exactly.
        pending = np.isinf(registers).any(axis=1) & (size > 0)
        horizon = np.where(pending, horizon * 2, horizon)
    return registers


def _few_at_a_time(texts: pd.Series) -> Iterator[pd.Series]:
    """Pieces of a batch for which the working arrays, that hold all shingles, stay small."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (i - start >= 256 or size + len(text or "") > AT_A_TIME):
            yield texts.iloc[start:i]
            start, size = i, 0
        size += len(text or "")
    if len(texts):
        yield texts.iloc[start:]


def band_keys(texts: pd.Series, bands: int, rows: int) -> list[list[int]]:
    """Keys of the bands of each text (none for a text without words)."""
    parts, weights, owner = [], [], []
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text)
        if len(hashes):
            distinct, counts = np.unique(hashes, return_counts=True)
            parts.append(distinct)
            weights.append(counts)
            owner.append(np.full(len(distinct), i))
    if not parts:
        return [[] for _ in texts]
    whole = signatures(
        np.concatenate(parts), np.concatenate(weights).astype(float), np.concatenate(owner), len(texts), bands * rows
    )
    bits = whole.view(np.uint64).reshape(len(texts), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, bits.shape[:2]).copy()
    for r in range(rows):
        key = _mixed(key * _M2 + bits[:, :, r])
    signed = key.view(np.int64)
    some = np.isfinite(whole[:, 0])
    return [signed[i].tolist() if some[i] else [] for i in range(len(texts))]


def occurrence_hashes(text: str | None) -> np.ndarray:
    """One hash for each (shingle, number of its occurrence): the multiset as a set."""
    hashes = np.sort(shingle_hashes(text))
    if not len(hashes):
        return hashes.view(np.int64)
    new = np.concatenate(([True], hashes[1:] != hashes[:-1]))
    first = np.maximum.accumulate(np.where(new, np.arange(len(hashes)), 0))
    number = (np.arange(len(hashes)) - first).astype(np.uint64)
    return _mixed(hashes + _GOLDEN * number).view(np.int64)


def bitmap(items: np.ndarray) -> np.ndarray:
    """One bit for each hash of ``items``, by its leading bits, as 64-bit integers."""
    bits = np.zeros(64 * BITMAP_LONGS, dtype=np.uint8)
    bits[items.view(np.uint64) >> np.uint64(64 - (64 * BITMAP_LONGS - 1).bit_length())] = 1
    return np.packbits(bits).view(np.int64)


def connected(links: DataFrame) -> DataFrame:
    """``id, label``: the smallest id of each connected part of ``a, b`` links.

    Every id hooks to its smallest neighbour by one aggregation, labels jump to
    their label's label, and the links are carried over to labels, where
    those within a label go. Each pass at least halves the ids that are left,
    so a clique or a star of thousands is one pass, and an id with thousands of
    links is a partial minimum like any other.
    """
    # Smallest end first: what is left of a link between two labels is one row.
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "near_edges")
    labels: DataFrame | None = None
    while True:
        both = edges.select("a", "b").union(edges.select("b", "a"))
        hooked = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label"))
        hooked = stored(hooked, "near_hooked")
        above = hooked.select(F.col("id").alias("j"), F.col("label").alias("far"))
        step = stored(hooked.join(above, hooked["label"] == above["j"]).select("id", F.col("far").alias("label")), "near_step")
        ends = edges.join(_named(step, "a", "la"), "a").join(_named(step, "b", "lb"), "b")
        ends = ends.where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct()
        before, edges = edges, stored(ends, "near_edges")
        if labels is None:
            labels = step
        else:
            old, labels = labels, stored(_moved(labels, step), "near_labels")
            released(old, step)
        released(before, hooked)
        if edges.limit(1).count() == 0:
            released(edges)
            return labels


def _named(labels: DataFrame, id: str, label: str) -> DataFrame:
    return labels.select(F.col("id").alias(id), F.col("label").alias(label))


def _moved(labels: DataFrame, step: DataFrame) -> DataFrame:
    """``labels`` after their labels were given the labels of ``step``."""
    far = labels.join(_named(step, "at", "to"), labels["label"] == F.col("at"), "left")
    return far.select("id", F.coalesce("to", "label").alias("label"))


def joined_classes(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``id, label`` after new ``a, b`` links, given that of the links before.

    The new links are carried over to the classes of their ends, so that only a
    link between two classes, or to a text without one, is followed.
    """
    if labels is None:
        return connected(links)
    ends = links.join(_named(labels, "a", "la"), "a", "left").join(_named(labels, "b", "lb"), "b", "left")
    step = connected(ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")))
    new = step.join(labels.select("id"), "id", "left_anti")
    moved = stored(_moved(labels, step).unionByName(new), "near_labels")
    released(labels, step)
    return moved


def text_ids(docs: DataFrame) -> tuple[DataFrame, int]:
    """``doc_id, text_id, worded`` of every row, and the seed of the ids.

    Equal texts share an id, a 64-bit hash. Different texts that met in one id
    would show as different digests; then the next seed is tried.
    """
    seed = 0
    while True:
        rows = docs.select(
            "doc_id",
            text_id(seed).alias("text_id"),
            F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
            F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
        )
        rows = stored(rows, "near_rows")
        met = rows.groupBy("text_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
        if met.where(F.col("lo") != F.col("hi")).limit(1).count() == 0:
            return rows.drop("digest"), seed
        seed += 1


def text_id(seed: int, column: str = "text"):
    return F.xxhash64(F.coalesce(column, F.lit("")), F.lit(seed))


def near_classes(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id, copy_of`` for every row of ``doc_id, text``.

    ``class_id`` is the smallest id in the row's class, ``copy_of`` the
    smallest id with the same text.

    Defined results: a null or empty text or one of white space alone is a
    class of its own (both ids are the row's own); texts of fewer than five
    words are one shingle; repeated rows are copies of one another; a null id
    counts as the largest, so a class has a null ``class_id`` only if all its
    ids are null; an empty table gives no rows.
    """
    placed, _, _ = _placed(docs, similarity, bands, rows)
    return placed


def _placed(docs: DataFrame, similarity: float, bands: int, rows: int) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their classes; ``text_id, class_id, copy_of`` of worded texts; the seed."""
    prepare(docs.sparkSession)
    members, seed = text_ids(docs)
    firsts = members.where("worded").groupBy("text_id").agg(F.min("doc_id").alias("copy_of"))
    labels = _text_classes(docs.select(text_id(seed).alias("uid"), "text"), similarity, bands, rows)
    named = firsts.join(labels, firsts["text_id"] == labels["id"], "left").select(
        "text_id", "copy_of", F.coalesce("label", "text_id").alias("label")
    )
    named = stored(named, "near_named")
    order = F.struct(F.coalesce("copy_of", F.lit((1 << 63) - 1)).alias("o"), F.col("text_id").alias("t"))
    ids = named.groupBy(F.col("label").alias("class_label")).agg(
        F.min("copy_of").alias("class_id"), F.min(order)["t"].alias("first_tid")
    )
    classes = named.join(ids, named["label"] == ids["class_label"]).select(
        F.col("text_id").alias("tid"), "class_id", "copy_of", (F.col("text_id") == F.col("first_tid")).alias("first")
    )
    classes = stored(classes, "near_classes")
    found = members.join(classes, F.when(F.col("worded"), F.col("text_id")) == F.col("tid"), "left")
    own = lambda c: F.when(F.col("worded"), F.col(c)).otherwise(F.col("doc_id")).alias(c)
    return found.select("doc_id", own("class_id"), own("copy_of")), classes, seed


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One document of each class, that with the smallest id; texts without words all stay.

    Keeps the columns of ``docs``. Joined on text and id together, so the rows
    of a class with many copies are spread.
    """
    _, classes, seed = _placed(docs, similarity, bands, rows)
    null_id = F.lit(-(1 << 63))
    first = classes.where("first").select("tid", F.coalesce("copy_of", null_id).alias("first_id"))
    worded = F.coalesce(F.col("row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    packed = keep_row(docs).select(
        "row", text_id(seed, "row.text").alias("text_id"), F.coalesce("row.doc_id", null_id).alias("did"), worded.alias("worded")
    )
    kept = packed.where("worded").join(
        first, (F.col("text_id") == F.col("tid")) & (F.col("did") == F.col("first_id"))
    )
    one = Window.partitionBy("text_id", "did").orderBy("did")
    kept = kept.withColumn("nth", F.row_number().over(one)).where("nth = 1")
    return kept.select("row.*").unionByName(packed.where(~F.col("worded")).select("row.*"))


def _text_classes(texts_by_id: DataFrame, similarity: float, bands: int, rows: int) -> DataFrame:
    """``id, label`` of all texts that are linked to another; the links are verified."""

    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([k for few in _few_at_a_time(texts) for k in band_keys(few, bands, rows)], dtype=object)
        give_back_memory()

    keyed = texts_by_id.select("uid", F.pandas_udf(keys, "array<long>")("text").alias("keys"))
    # Copies of a text have its keys: they meet here, before the keys are spread.
    keyed = stored(keyed.where(F.size("keys") > 0).dropDuplicates(["uid"]), "near_keys")
    buckets = keyed.select(F.posexplode("keys").alias("band", "key"), "uid")
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("members")).where(F.col("members") > 1)
    buckets = stored(buckets.join(shared, ["band", "key"]), "near_shared")

    candidates = buckets.groupBy("uid").agg(F.sum("members").alias("weight"))
    texts = texts_by_id.join(candidates.select("uid"), "uid", "left_semi").dropDuplicates(["uid"])

    def sets(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            items = [occurrence_hashes(t) for t in batch]
            yield pd.DataFrame({"items": items, "bits": [bitmap(x) for x in items]})
        give_back_memory()

    told = texts.select("uid", F.pandas_udf(sets, "items array<long>, bits array<long>")("text").alias("t"))
    multisets = stored(told.select("uid", "t.items", "t.bits"), "near_multisets")

    known = multisets.select("uid", F.size("items").alias("size"), "bits").join(keyed, "uid")
    members = stored(buckets.join(known.join(candidates, "uid"), "uid"), "near_open")
    # The member of most weight of each bucket.
    first = members.groupBy("band", "key").agg(F.max(F.struct("weight", "uid")).alias("f"))
    first = first.select("band", "key", F.col("f.uid").alias("first"))
    ranked = members.join(first, ["band", "key"]).withColumn("centre", F.col("uid") == F.col("first")).drop("first")
    ranked = stored(ranked, "near_round")
    pairs = stored(_pairs(ranked, similarity, bands).distinct(), "near_pairs")
    verified = stored(_verified(pairs, multisets, similarity), "near_verified")
    labels = joined_classes(None, verified)
    released(members, pairs, verified)

    # Read twice, so written: one narrow row for each member that was no centre.
    rest = ranked.where(~F.col("centre")).select("band", "key", "uid").join(_named(labels, "uid", "label"), "uid", "left")
    rest = stored(rest.withColumn("label", F.coalesce("label", "uid")), "near_rest")
    open_texts = stored(_unsettled(rest).select("uid", "label").distinct().join(known, "uid"), "near_unsettled")
    released(ranked, rest)
    if open_texts.limit(1).count() > 0:
        pairs = stored(_rare_pairs(open_texts, multisets, similarity, bands).distinct(), "near_pairs")
        verified = stored(_verified(pairs, multisets, similarity), "near_verified")
        labels = joined_classes(labels, verified)
        released(pairs, verified)
    released(open_texts, keyed, buckets, multisets)
    return labels


def _pairs(ranked: DataFrame, similarity: float, bands: int) -> DataFrame:
    """``a, b``: members of a bucket with its centre that may be near.

    A large bucket's members are dealt out by a hash of their id, and each
    part meets the centre.
    """
    salts = F.ceil(F.col("members") / SALT_MEMBERS)
    members = ranked.withColumn("salt", F.pmod(F.xxhash64("uid"), salts))
    centres = ranked.where("centre").select(
        F.col("band").alias("cb"), F.col("key").alias("ck"), F.col("uid").alias("c"),
        F.col("size").alias("csize"), F.col("bits").alias("cbits"), F.col("keys").alias("ckeys"),
        F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("cs"),
    )
    met_before = reduce(or_, [(F.col("band") > j) & (F.col("keys")[j] == F.col("ckeys")[j]) for j in range(bands)])
    met = (F.col("band") == F.col("cb")) & (F.col("key") == F.col("ck")) & (F.col("salt") == F.col("cs"))
    pairs = members.join(centres, met & (F.col("uid") != F.col("c")) & ~met_before & _viable(similarity))
    return pairs.select(F.least("uid", "c").alias("a"), F.greatest("uid", "c").alias("b"))


def _viable(similarity: float) -> Column:
    """Whether ``size, bits`` and ``csize, cbits`` allow the similarity."""
    lacks = lambda x, y: sum(F.bit_count(F.col(x)[i].bitwiseAND(F.bitwise_not(F.col(y)[i]))) for i in range(BITMAP_LONGS))
    most = F.least(F.col("size") - lacks("bits", "cbits"), F.col("csize") - lacks("cbits", "bits"))
    return _enough(most, similarity)


def _enough(shared: Column, similarity: float) -> Column:
    """Whether texts of ``size`` and ``csize`` that share so many are similar enough."""
    return shared * F.lit(1 + similarity) >= F.lit(similarity) * (F.col("size") + F.col("csize")) - F.lit(1e-6)


def _rare_items(texts: DataFrame, multisets: DataFrame, similarity: float) -> DataFrame:
    """``uid, item, place``: of each text's hashes, rarest first, those before which no near text can part.

    A near text shares at least ``similarity`` of them, so one at least of the
    others and one more; in one order of all hashes the first that two near
    texts share is then among these for both. Hashes of one text alone come
    first and meet nothing, so they are only counted.
    """
    spread = multisets.join(texts.select("uid"), "uid", "left_semi").select("uid", F.explode("items").alias("item"))
    often = spread.groupBy("item").agg(F.count("*").alias("n")).where("n > 1")
    ordered = spread.join(often, "item").groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("n", "item"))).alias("ordered"))
    ordered = ordered.join(texts.select("uid", "size"), "uid").withColumn("alone", F.col("size") - F.size("ordered"))
    wanted = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - F.lit(1e-6)) + 1 - F.col("alone")
    rare = F.slice("ordered", F.lit(1), F.greatest(F.lit(0), wanted).cast("int"))
    rows = ordered.select("uid", "alone", F.posexplode(rare).alias("i", "x"))
    return rows.select("uid", F.col("x.item").alias("item"), (F.col("alone") + F.col("i")).alias("place"))


def _rare_pairs(texts: DataFrame, multisets: DataFrame, similarity: float, bands: int) -> DataFrame:
    """``a, b``: texts of different classes that share a bucket and may be near.

    ``texts`` has ``uid, label, size, bits, keys``. Of two texts of different
    classes one at least is not of the class that most of a hash's texts
    belong to: those meet all, and the others never meet among themselves. A
    hash of many texts has them dealt out as in ``_pairs``.
    """
    # At the first hash that two texts share, all that they share is from there on: here of
    # a text and the smallest that has the hash, below of the two texts.
    rare = stored(_rare_items(texts, multisets, similarity).join(texts.select("uid", "label", "size"), "uid"), "near_rare")
    smallest = rare.groupBy("item").agg(F.min("size").alias("csize"))
    early = rare.join(smallest, "item").where(_enough(F.col("size") - F.col("place"), similarity))
    items = stored(early.select("uid", "item", "place", "label"), "near_items")
    of_class = items.groupBy("item", "label").agg(F.count("*").alias("n"))
    met = of_class.groupBy("item").agg(
        F.sum("n").alias("members"), F.max(F.struct("n", "label"))["label"].alias("most"), F.count("*").alias("classes")
    )
    met = met.where("classes > 1").drop("classes")
    held = stored(items.join(met, "item").join(texts.drop("label"), "uid"), "near_meeting")
    salts = F.ceil(F.col("members") / SALT_MEMBERS)
    one = held.withColumn("salt", F.pmod(F.xxhash64("uid"), salts))
    other = held.where("label <> most").select(
        F.col("item").alias("ci"), F.col("uid").alias("c"), F.col("label").alias("cl"), F.col("place").alias("cplace"),
        F.col("size").alias("csize"), F.col("bits").alias("cbits"), F.col("keys").alias("ckeys"),
        F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)).alias("cs"),
    )
    met_here = (F.col("item") == F.col("ci")) & (F.col("salt") == F.col("cs"))
    apart = (F.col("label") != F.col("cl")) & ((F.col("label") == F.col("most")) | (F.col("uid") < F.col("c")))
    by_place = F.least(F.col("size") - F.col("place"), F.col("csize") - F.col("cplace"))
    in_bucket = reduce(or_, [F.col("keys")[j] == F.col("ckeys")[j] for j in range(bands)])
    pairs = one.join(other, met_here & apart & _enough(by_place, similarity) & in_bucket & _viable(similarity))
    return pairs.select(F.least("uid", "c").alias("a"), F.greatest("uid", "c").alias("b"))


def _unsettled(members: DataFrame) -> DataFrame:
    """The buckets that still hold texts of more than one class."""
    apart = members.groupBy("band", "key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return members.join(apart.where(F.col("lo") != F.col("hi")).select("band", "key"), ["band", "key"])


def _verified(pairs: DataFrame, multisets: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose multisets have at least this weighted Jaccard index."""
    one = multisets.select(F.col("uid").alias("ua"), F.col("items").alias("xa"))
    two = multisets.select(F.col("uid").alias("ub"), F.col("items").alias("xb"))
    held = pairs.join(one, F.col("a") == F.col("ua")).join(two, F.col("b") == F.col("ub"))
    small, large = F.least(F.size("xa"), F.size("xb")), F.greatest(F.size("xa"), F.size("xb"))
    held = held.where(small >= large * F.lit(similarity) - F.lit(1e-6))
    common = F.size(F.array_intersect("xa", "xb"))
    jaccard = common / (F.size("xa") + F.size("xb") - common)
    return held.select("a", "b", jaccard.alias("similarity")).where(F.col("similarity") >= similarity)
