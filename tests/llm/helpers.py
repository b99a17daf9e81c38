"""Small documents with every awkward case, and plain versions to compare with."""

import random

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, row string"


def words(n, seed=0, vocabulary=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioklmnprst") for _ in range(r.randint(2, 8))) + str(r.randrange(vocabulary) % 7 or "") for _ in range(n))


def awkward_documents(spark, more=()):
    """Nulls, empty and long texts, ties, repeated rows; two extra columns that clash."""
    base = words(120, 1)
    near = base.split(" ")
    near[60] = "changed"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "b"),
        (3, " ".join(near), "de", "a"),
        (4, None, "en", "a"),
        (5, "", None, "b"),
        (6, " \n\t ", "en", None),
        (7, words(30_000, 2), "en", "a"),
        (8, "x" * 20_000, None, None),
        (9, "one two three", "fr", "c"),
        (10, "one two three", "fr", "c"),
        (11, "mail me@x.org or +1 (504) 555-2652, 4111 1111 1111 1111 at 10.0.0.1\nnew é\U0001f642 line", "en", "b"),
        (None, words(80, 3), "en", "a"),
        (12, words(90, 4), "en", "a"),
        (12, words(90, 4), "en", "a"),
        *more,
    ]
    full = [(*r, len(r[1] or ""), "clash", "clash") for r in rows]
    return spark.createDataFrame(full, DOC_SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], DOC_SCHEMA)


def texts_by_id(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
