"""Every operator on documents takes one very long text beside short ones."""

import pytest

import corpus_pipeline
from vecloom.llm import decontamination, digest_index, licenses, line_dedup, mixing, ngram_join, quality, ranked_search, toxicity

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda".split()
LONG = " ".join(f"{WORDS[i % 11]}{i % 1009}" for i in range(120_000))
ROWS = [(1, LONG), (2, LONG + " end"), (3, "short text of a few words that is kept here"), (4, "x" * 1_000_000), (5, None), (6, "")]


@pytest.fixture
def docs(docs_of):
    return docs_of(ROWS)


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (3, 0, 1)], "doc_id bigint, quality int, toxic int")


def test_row_local_operators(docs, labels):
    assert {r.doc_id: r.n_words for r in licenses.scan(docs).collect()}[1] == 120_000
    for module in (toxicity, quality):
        found = {r.doc_id: r.score for r in module.classify(docs, labels).collect()}
        assert len(found) == 6 and all(0 <= s <= 1 for s in found.values())


def test_operators_that_compare(spark, docs):
    assert {r.doc_id for r in digest_index.decide(docs).filter("kept").collect()} == {1, 2, 3, 4, 5}
    near = {r.doc_id: r.component_id for r in ngram_join.join(docs).collect()}
    assert near[1] == near[2] == 1 and near[4] == 4
    lines = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.decide(docs).collect()}
    assert lines[1] == (1, 0) and lines[2] == (1, 1) and lines[4] == (1, 0)
    items = spark.createDataFrame([(7, " ".join(LONG.split()[-12:]))], "item_id bigint, text string")
    leaks = {r.doc_id: r.n_hit for r in decontamination.report(docs, items).collect()}
    assert leaks[1] > 0 and leaks[2] > 0 and leaks[3] == 0
    best = ranked_search.rank(docs, items, 2).collect()
    assert {r.doc_id for r in best} == {1, 2}
    assert {r.doc_id: r.size for r in mixing.decide(docs).collect()}[1] == 120_000


def test_pipeline_stages(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(7, "not in any of these documents at all, not one of them")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    assert {r.doc_id for r in docs.collect()} >= {1, 3, 4}
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    assert len([p for p in pieces if p.doc_id == 1]) > 20
