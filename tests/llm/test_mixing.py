import re
from collections import defaultdict

from pyspark.sql import functions as F

from llm.helpers import awkward_documents, empty_documents, words
from tillcast.llm import mixing


def water_level(sizes, weights=(3, 1, 2), share=1.5, most=2):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target = dict.fromkeys(order, 0.0)
    free, left = set(order), share * sum(sizes.values())
    while free:
        step = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if step[s] > most * sizes[s]}
        if not over:
            target.update(step)
            break
        for s in over:
            target[s] = most * sizes[s]
        left = share * sum(sizes.values()) - sum(target[s] for s in order if s not in free - over)
        free -= over
    return target


def test_mix_meets_its_targets(spark):
    docs = awkward_documents(spark, [(100 + i, words(20 + i, i), "en", f"s{i % 4}") for i in range(60)])
    rows = mixing.mix(docs, rows_per_bucket=7, carry=True).collect()
    assert len(rows) == docs.count()
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        s = r.row.source
        assert r.size == len((r.row.text or "").encode().split()) and 0 <= r.taken <= 2 * r.size
        assert len(r.positions) == (0 if not r.size else -(-r.taken // r.size)) and all(0 <= p <= 1 for p in r.positions)
        size[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
    want = water_level(size)
    for s in size:
        assert abs(target[s] - want[s]) < 1e-6 and 0 <= target[s] - taken[s] < 1 + 1e-6
    again = mixing.mix(docs.repartition(5), rows_per_bucket=1000, carry=True).collect()
    key = lambda r: (r.row.doc_id or -1, r.size, r.taken, [round(p, 12) for p in r.positions])
    assert sorted(map(key, rows)) == sorted(map(key, again))
    assert mixing.mix(empty_documents(spark)).count() == 0


def test_targets_are_the_water_level(spark):
    sizes = {"a": 5, "b": 1000, "c": 40, "d": 300, "e": 7, None: 90, "f": 0, "g": 2000}
    per_source = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    for share in (0.1, 0.5, 1.0, 1.5, 1.99, 2.0):
        got = {r.source: r.target for r in mixing.source_targets(per_source, share=share).collect()}
        want = water_level(sizes, share=share)
        assert all(abs(got[s] - want[s]) < 1e-6 for s in sizes), share
        assert abs(sum(got.values()) - share * sum(sizes.values())) < 1e-6


def test_positions_follow_the_curriculum(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "en", "ab"[i % 2]) for i in range(400)], "doc_id long, text string, lang string, source string")
    late = mixing.mix(docs, weights=(1, 1), share=1.0, curriculum=((0.01, 2.0), (2.0, 0.01)), carry=True).collect()
    mean = {s: sum(sum(r.positions) for r in late if r.row.source == s) / 200 for s in "ab"}
    assert mean["a"] > 0.6 and mean["b"] < 0.4


def test_training_order_repeats_whole_documents(spark):
    docs = awkward_documents(spark)
    mixed = {}
    for r in mixing.mix(docs, carry=True).collect():
        mixed.setdefault(r.row.text, 0)
        mixed[r.row.text] += len(r.positions)
    ordered = mixing.training_order(docs)
    assert ordered.columns == docs.columns
    got = {}
    for r in ordered.collect():
        got[r.text] = got.get(r.text, 0) + 1
    assert got == {t: n for t, n in mixed.items() if n}
    assert mixing.training_order(empty_documents(spark)).count() == 0


def test_words_are_counted_without_a_list_of_them(spark):
    from tillcast.llm.common import word_count

    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a  b\tc\n", "é\U0001f642 \u00a0 x\x1cy", "one " * 5000, "w w\x00w"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string").select("i", "text", word_count(F.col("text")).alias("n"))
    assert "regexp_extract_all" not in rows._jdf.queryExecution().optimizedPlan().toString()
    for r in rows.collect():
        assert r.n == len(re.findall(r"[^ \t\n\x0b\x0c\r]+", r.text or ""))
