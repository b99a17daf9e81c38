import math
import random
import zlib
from collections import Counter

from llm.helpers import awkward_documents, empty_documents
from tillcast.llm import langid


def test_held_out_accuracy_on_the_test_table(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_awkward_documents(spark):
    rows = langid.identify(awkward_documents(spark)).collect()
    assert len(rows) == 14
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.doc_id in (4, 5, 6):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert langid.identify(empty_documents(spark)).count() == 0


def test_long_texts_count_like_short_blocks():
    text = "abc déf " * 40_000
    old = langid.BLOCK
    whole = langid.ngram_buckets(text, 14)
    try:
        langid.BLOCK = 1 << 30
        one = langid.ngram_buckets(text, 14)
    finally:
        langid.BLOCK = old
    assert (whole[0] == one[0]).all() and (whole[1] == one[1]).all()


def plain_answers(rows):
    """Naive Bayes by dictionaries: text -> (language, share) for rows of (doc_id, text, lang)."""
    counts, priors = {}, Counter()
    for doc_id, text, lang in rows:
        held_out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2
        if not held_out and text is not None and lang is not None:
            priors[lang] += 1
            into = counts.setdefault(lang, Counter())
            for b, n in zip(*(x.tolist() for x in langid.ngram_buckets(text, langid.BITS))):
                into[b] += n
    cells = 1 << langid.BITS
    totals = {k: sum(c.values()) + langid.SMOOTHING * cells for k, c in counts.items()}

    def answer(text):
        found = list(zip(*(x.tolist() for x in langid.ngram_buckets(text, langid.BITS))))
        if not found or not counts:
            return "und", 0.0
        score = {
            k: math.log(priors[k] / sum(priors.values())) + sum(n * math.log((c[b] + langid.SMOOTHING) / totals[k]) for b, n in found)
            for k, c in counts.items()
        }
        best = max(sorted(score), key=score.get)
        return best, 1 / sum(math.exp(max(-700.0, v - score[best])) for v in score.values())

    return answer


def test_equals_plain_naive_bayes_also_in_language_blocks(spark):
    r = random.Random(1)
    alphabets = {f"l{i:02d}": "".join(r.sample("abcdefghijklmnopqrstuvwxyzäöüßéñ", 9)) for i in range(7)}
    rows = []
    for i in range(140):
        lang = r.choice(list(alphabets))
        rows.append((i, " ".join("".join(r.choices(alphabets[lang], k=r.randint(2, 7))) for _ in range(r.randint(1, 12))), lang))
    rows += [(200, None, "l00"), (201, "12 34", "l01"), (202, "ab", None), (None, "abc abc", "l02")]
    docs = spark.createDataFrame([(*x, "clash", 0.5) for x in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    answer = plain_answers(rows)
    one = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs).collect()}
    blocks = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(docs, max_cells=3 << langid.BITS).collect()}
    assert len(langid.train(docs, max_cells=3 << langid.BITS)) == 3
    for doc_id, text, _ in rows:
        lang, score = answer(text)
        for got in (one[doc_id], blocks[doc_id]):
            assert got[0] == lang and abs(got[1] - score) < 1e-3


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {(r.lang_pred, r.score) for r in langid.identify(docs).collect()} == {("und", 0.0)}
