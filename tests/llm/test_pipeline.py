from llm_fixtures import awkward, labels, nothing  # noqa: F401
import corpus_pipeline
from namewire.llm.base import stored
from namewire.llm.queries import ORACLE, QUERIES


def test_queries():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES)


def test_stages(spark, awkward, small):
    docs = awkward
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stored(stage(spark, docs, small), name)
        assert left.columns == docs.columns
        docs = left
    ids = [r.doc_id for r in docs.collect()]
    assert ids.count(2) == 0 and ids.count(None) == 2 and 7 not in ids
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).count() == docs.count()


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small).orderBy("start").collect()
    assert 0 < len(rows) < 200 and rows[0].start == 0
    assert all(b.start == a.start + a.n_tokens and a.doc_id < b.doc_id for a, b in zip(rows, rows[1:]))
