import random
from collections import Counter

import numpy as np

from llm.helpers import awkward_documents, empty_documents, words
from tillcast.llm import bagminhash as B


def multiset(text):
    w = text.split()
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)])


def brute(texts):
    """Smallest id of each class, by all pairs."""
    ids = list(texts)
    bags = {i: multiset(texts[i]) for i in ids}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and 0.8 * max(bags[a].total(), bags[b].total()) <= min(bags[a].total(), bags[b].total()):
                if (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total():
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_registers_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    elements = B._mixed(np.arange(1, 61, dtype=np.uint64))
    for _ in range(5):
        a, b = rng.integers(0, 12, 60), rng.integers(0, 12, 60)
        b = np.where(rng.random(60) < 0.7, a, b)
        parts = [(elements[w > 0], w[w > 0].astype(float)) for w in (a, b)]
        r = B.signatures(
            np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]),
            np.concatenate([np.full(len(p[0]), i) for i, p in enumerate(parts)]), 2, 4000,
        )
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((r[0] == r[1]).mean() - want) < 0.04


def near_corpus(seed=0, groups=6, copies=25):
    r = random.Random(seed)
    texts, n = {}, 100
    for g in range(groups):
        base = words(60 + 15 * g, 50 + g).split()
        for c in range(copies):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
            texts[n] = " ".join(w)
            n += 1
    return texts


def test_classes_equal_brute_force(spark):
    texts = near_corpus()
    docs = awkward_documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    rows = B.near_classes(docs).collect()
    assert len(rows) == docs.count()
    got = {r.doc_id: r.class_id for r in rows}
    want = brute(texts)
    assert all(got[i] == want[i] for i in texts)
    assert got[1] == got[2] == 1 and got[4] == 4 and got[5] == 5 and got[6] == 6 and got[10] == 9
    assert got[None] is None and B.near_classes(empty_documents(spark)).count() == 0


def test_one_of_each_class_stays(spark):
    texts = near_corpus(3, groups=3, copies=12)
    docs = awkward_documents(spark, [(i, t, "en", "a") for i, t in texts.items()])
    kept = B.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id if r.doc_id is not None else -1) for r in kept.collect())
    want = sorted(set(brute(texts).values()) | {-1, 1, 4, 5, 6, 7, 8, 9, 11, 12})
    if 3 in ids:  # one changed word of 120 is near
        raise AssertionError("a near copy stayed")
    assert ids == want


def test_multiset_counts_matter():
    few, many = "a b c d e " * 2, "a b c d e " * 40
    x, y = B.occurrence_hashes(few), B.occurrence_hashes(many)
    assert len(set(x) & set(y)) == len(x) == 6 and len(y) == 196


def classes_of(links):
    label = {}
    for a, b in links:
        label.setdefault(a, a), label.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return label


def test_connected_parts_of_chains_stars_and_cliques(spark):
    r = random.Random(4)
    names = r.sample(range(-(10**12), 10**12), 400)
    links = [(names[i], names[i + 1]) for i in range(60)]  # a chain in any order of ids
    links += [(names[100], n) for n in names[101:160]] + [(a, b) for a in names[200:215] for b in names[200:215] if a != b]
    links += [(r.choice(names[300:]), r.choice(names[300:])) for _ in range(70)]
    links = [(a, b) for a, b in links if a != b]
    frame = spark.createDataFrame(links, "a long, b long")
    assert {x.id: x.label for x in B.connected(frame).collect()} == classes_of(links)
    # in three rounds, each joining the classes of those before
    labels = None
    for part in (links[::3], links[1::3], links[2::3]):
        labels = B.joined_classes(labels, spark.createDataFrame(part, "a long, b long"))
    assert {x.id: x.label for x in labels.collect()} == classes_of(links)
    assert B.connected(frame.limit(0)).count() == 0


def test_bitmaps_bound_what_two_texts_share():
    r = random.Random(6)
    for n in (3, 80, 900, 6000):
        base = words(n, n).split()
        other = [w if r.random() < 0.9 else f"x{r.randrange(10**6)}" for w in base]
        x, y = B.occurrence_hashes(" ".join(base)), B.occurrence_hashes(" ".join(other))
        shared = len(set(x.tolist()) & set(y.tolist()))
        lacks = [sum(int(v).bit_count() for v in (p & ~q).view(np.uint64)) for p, q in ((B.bitmap(x), B.bitmap(y)), (B.bitmap(y), B.bitmap(x)))]
        assert shared <= min(len(x) - lacks[0], len(y) - lacks[1])
        if n == 900:  # and closely so
            assert min(len(x) - lacks[0], len(y) - lacks[1]) < shared + 0.5 * (len(x) - shared)


def test_large_buckets_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(B, "SALT_MEMBERS", 4)
    texts = near_corpus(8, groups=2, copies=40)
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in B.near_classes(docs).collect()} == brute(texts)


def passage_corpus(n, seed=0):
    """Texts that share a passage but are far apart; every third is a near copy of the one before."""
    r = random.Random(seed)
    passage, texts = words(60, 700), {}
    for i in range(n):
        if i % 3 == 2:
            own = texts[i - 1].split()[60:]
            own[r.randrange(3, 35)] = f"edit{i}"
            texts[i] = " ".join([passage, *own])
        else:
            texts[i] = f"{passage} {words(40, 1000 + i)}"
    return texts


def test_a_bucket_of_many_classes_is_carried_once(spark, monkeypatch):
    carried, written = [], B.stored

    def stored(df, name):
        table = written(df, name)
        if "band" in table.columns and "centre" in table.columns:
            carried.append(table.count())
        return table

    monkeypatch.setattr(B, "stored", stored)
    for n in (30, 90):
        carried.clear()
        texts = passage_corpus(n)
        docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
        want = brute(texts)
        assert len(set(want.values())) == n - n // 3
        # One register a band: most texts share buckets with most others.
        assert {r.doc_id: r.class_id for r in B.near_classes(docs, rows=1).collect()} == want
        assert len(carried) == 1 and carried[0] <= B.BANDS * n


def test_rare_shingles_bring_all_near_pairs_of_different_classes(spark, monkeypatch):
    monkeypatch.setattr(B, "SALT_MEMBERS", 4)
    texts = near_corpus(5, groups=3, copies=20) | {1000 + i: t for i, t in passage_corpus(30, 1).items()}
    ids, bags = list(texts), {i: multiset(t) for i, t in texts.items()}
    near = {(a, b) for a in ids for b in ids if a < b and (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total()}
    items = {i: B.occurrence_hashes(t) for i, t in texts.items()}
    sets = spark.createDataFrame([(i, x.tolist()) for i, x in items.items()], "uid long, items array<long>")
    schema = "uid long, label long, size int, bits array<long>, keys array<long>"
    # A class of its own each; then the first group's first half one class; then one without a shared bucket.
    for label, key in ((lambda i: i, lambda i: 1), (lambda i: min(i, 110) if i > 110 else 100, lambda i: 1), (lambda i: i, lambda i: i if i == 1001 else 1)):
        rows = [(i, label(i), len(x), B.bitmap(x).tolist(), [key(i), i]) for i, x in items.items()]
        pairs = B._rare_pairs(spark.createDataFrame(rows, schema), sets, 0.8, 2)
        found = [(p.a, p.b) for p in pairs.collect()]
        want = {(a, b) for a, b in near if label(a) != label(b) and key(a) == key(b)}
        assert want and want <= set(found)
        assert all(label(a) != label(b) and key(a) == key(b) for a, b in found)
