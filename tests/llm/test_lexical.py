import math
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import awkward_documents, empty_documents, words
from tillcast.llm import lexical

ITEM = "item_id long, text string, doc_id string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, top=10):
    held = [(i, TERM.findall((t or "").translate(SMALL))) for i, t in docs]
    held = [(i, len(t), Counter(t)) for i, t in held if t]
    n_docs, total = len(held), sum(n for _, n, _ in held)
    df = Counter(t for _, _, c in held for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, n, counts in held:
            m = 25 + (75 * n * n_docs) // total
            score = 0
            for t in TERM.findall((text or "").translate(SMALL)):
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * counts[t]) // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        scored.sort(key=lambda s: s[:3])
        out += [(item_id, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [lexical.MAX_INDEX_BYTES, 400])
def test_equals_brute_force(spark, limit):
    docs = awkward_documents(spark, [(20 + i, words(30 + i, i), "en", "a") for i in range(60)])
    plain = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, "Mail ME@x.org one one ONE two"), (2, None), (3, " ,. "), (4, words(40, 7)), (4, words(40, 7)), (None, "one Three é\U0001f642 line")]
    items += [(5, plain[0][1]), (6, "İ É Two"), (7, words(200, 8))]
    frame = spark.createDataFrame([(*i, "clash") for i in items], ITEM)
    got = lexical.rank_documents(docs, frame, max_index_bytes=limit)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(plain, items)


def test_empty(spark):
    items = spark.createDataFrame([(1, "one", "")], ITEM)
    none = spark.createDataFrame([], ITEM)
    assert lexical.rank_documents(empty_documents(spark), items).count() == 0
    assert lexical.rank_documents(awkward_documents(spark), none).count() == 0


def test_heaps_merge_like_a_sort():
    rng = np.random.default_rng(1)
    item, score, doc = rng.integers(0, 3, 900), rng.integers(1, 20, 900), rng.permutation(900)
    heaps = lexical.Heaps(3, 7)
    for at in range(0, 900, 100):
        s = slice(at, at + 100)
        heaps.offer(item[s], score[s], doc[s], np.zeros(100, dtype=bool))
    for i in range(3):
        want = sorted((-score[k], doc[k]) for k in range(900) if item[k] == i)[:7]
        assert sorted((-s, -d) for s, _, d in heaps.heaps[i]) == want


def test_sums_beyond_doubles_are_exact():
    index = lexical.Index([(0, 1, b"a", 1 << 30), (0, 1, b"b", 1)])
    import pandas as pd

    frame = pd.DataFrame({"doc_id": pd.array([5], dtype="Int64"), "n": [2], "terms": [np.array([0, 1], np.int32).tobytes()], "counts": [np.array([1, 1]).tobytes()]})
    heaps = lexical.Heaps(1, 10)
    lexical.score_batch(index, np.array([9_000, 7]), 1, 2, frame, heaps)
    m = 25 + 75 * 2 // 2
    assert heaps.heaps[0][0][0] == (9_000 * (1 << 30) + 7) * (1_000_000_000 // (1000 + 8 * m))
