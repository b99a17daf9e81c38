import corpus_pipeline
from llm.helpers import awkward_documents, empty_documents, words
from tillcast.llm import queries


def test_stages_chain_on_awkward_documents(spark):
    docs = awkward_documents(spark, [(100 + i, words(80, 900 + i) + f" mail a{i}@b.org", "en", "ab"[i % 2]) for i in range(40)])
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"test_{number}")
        assert {r.doc_id for r in docs.collect()} <= before
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = {r.doc_id for r in docs.collect()}
    assert 1 in ids and not ids & {2, 3, 4, 5, 6, 8, 9, 10} and docs.where("n_tokens < 50").count() == 0


def test_an_empty_table_passes_through(spark):
    docs = empty_documents(spark)
    columns = docs.columns
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.stored(stage(spark, docs, ""), f"empty_{number}")
        assert docs.count() == 0
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns


def test_all_fourteen_are_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert set(queries.ORACLE_SQL) <= names
