import corpus_pipeline
from tabwright.llm import language, neardup, quality_rules, secrets
from tabwright.llm.queries import QUERIES


def test_names():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline(spark, some):
    """The rows of the last stage are the pieces of what the earlier stages keep, applied one after the other."""
    docs = some
    for stage in (language.accept, quality_rules.accept, neardup.one_of_each, secrets.mask):
        docs = stage(docs)
        assert docs.columns == some.columns
    want = {r["doc_id"] for r in docs.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == want
    assert 0 < len(want) < some.count()
