import hashlib
import re

from pyspark.sql import functions as F

from llm.helpers import awkward_documents, empty_documents
from tillcast.llm import pii
from tillcast.llm.common import stored


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(re.sub("[^0-9]", "", m)) <= 19 and luhn(re.sub("[^0-9]", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(re.sub("[^0-9]", "", m)) <= 15),
]


def plain(text):
    return [(k, m.start(), m.end()) for k, p, ok in PLAIN for m in re.finditer(p, text or "") if ok(m.group())]


TEXTS = [
    "a@b.c_d@e.f x@y a.b+c@d-e.f.g. @x.y a@b..c",
    "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.0004 1.2.3 00000000000000000000001.1.1.1",
    "4111-1111-1111-1111x4111 1111 1111 1112 41111111111111111111 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1",
    "+12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +1(2)3 +",
    "é\x01a@b.co\x01\U0001f6421.2.3.4\x02",
    " ".join(f"u{i}@h{i}.com" for i in range(400)),
    "9" * 5000 + "a" * 5000 + "@" + "b." * 3000 + " +" + "1 " * 3000,
]


def test_base_spans_equal_plain_patterns(spark):
    docs = awkward_documents(spark, [(1000 + i, t, "en", "a") for i, t in enumerate(TEXTS)])
    rows = pii.detect(docs, keep=("doc_id", "text"))
    report = pii.span_report(docs).collect()
    assert len(report) == docs.count()
    by_id = {r.doc_id: r.text for r in docs.collect()}
    for r in report:
        want = plain(by_id[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), r.doc_id
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, *_ in want) for kind in pii.KINDS)
        assert set(listed.split(",")) <= set(r.spans.split(",")) or not listed
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert pii.span_report(empty_documents(spark)).count() == 0


def test_redacted_texts_hold_no_base_span(spark):
    docs = awkward_documents(spark, [(1000 + i, t, "en", "a") for i, t in enumerate(TEXTS)])
    out = pii.redact(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert not plain(r.text) and r.n_chars == len(r.text or "")
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[11] == "mail [EMAIL] or [PHONE], [CARD] at [IP]\nnew é\U0001f642 line" and texts[4] is None and texts[5] == ""


def test_disguised_addresses_are_added_and_plain_words_left(spark):
    plain_rows = [(2000 + i, f"write u{i}@site{i % 7}.org today, host 10.0.{i % 200}.1 or call +1 (504) 555-{1000 + i} now", "en", "a") for i in range(300)]
    odd = [(9000, "reach me (at) site.org soon", "en", "a"), (9001, "nothing here at all. 12 of 34", "en", "a"), (9002, "number 4111111111111112 fails", "en", "a")]
    spans = {r.doc_id: r.spans for r in pii.span_report(awkward_documents(spark, plain_rows + odd)).collect()}
    assert spans[9000].startswith("email:") and spans[9001] == "" and spans[9002] == ""


def test_trees_read_back_as_the_model(spark):
    tree = pii.parse_tree("DecisionTree\n  If (feature 0 <= 0.5)\n   If (feature 2 <= 1.5)\n    Predict: -1.0\n   Else (feature 2 > 1.5)\n    Predict: 2.5E-3\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n")
    assert tree == (0, 0.5, (2, 1.5, -1.0, 0.0025), 1.0)


def test_cards_beside_other_digits_and_numbers_that_are_no_phones(spark):
    plain_rows = [
        (2000 + i, f"call +1 (504) 555-{1000 + i} now, host 10.0.{i % 200}.1, card 4111 1111 1111 1111 and u{i}@site.org", "en", "a") for i in range(300)
    ]
    odd = [
        (9000, "card 4111 1111 1111 1111 2027 ok", "en", "a"),
        (9001, "two 4111 1111 1111 1111 4111 1111 1111 1111 ok", "en", "a"),
        (9002, "order number 504-555-2652 shipped", "en", "a"),
        (9003, "please call 504-555-2652 today", "en", "a"),
        (9004, "write to ann at site dot org today", "en", "a"),
        (9005, "4111.1111.1111.1111", "en", "a"),
    ]
    docs = awkward_documents(spark, plain_rows + odd)
    spans = {r.doc_id: r.spans for r in pii.span_report(docs).collect()}
    assert spans[9000] == "card:5:24" and spans[9001].startswith("card:4:23") and "phone" not in spans[9001]
    assert spans[9002] == "" and spans[9003] == "phone:12:24"
    assert spans[9004] == "email:9:28" and spans[9005] == "card:0:19"
    texts = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert texts[9000] == "card [CARD] 2027 ok" and texts[9002] == "order number 504-555-2652 shipped"


def test_trees_are_trained_on_the_candidates_of_all_texts(spark, monkeypatch):
    """Twelve thousand texts with an address each: the address and its three disguises are all there."""
    tables = []
    monkeypatch.setattr(pii, "stored", lambda df, name: tables.append(stored(df, name)) or tables[-1])
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.format_string("write to u%d@site.org number 12.5", "id").alias("text"))
    assert pii.train(docs) is not None
    (table,) = tables
    weights = {(r.label, r.k): r.n for r in table.groupBy("label", "k").agg(F.sum("n").alias("n")).collect()}
    assert weights[(1.0, 0)] == 48_000 and weights[(0.0, 2)] == 12_000  # a word of each text for every kind
    assert table.count() < 200
