"""The queries' SQL, and the pipeline stage by stage."""

import importlib

import pytest
from helpers import clashing, digest
from oracle_check import connect, differences
from test_joins import brute_classes
from test_native import base_spans
from tokenizers import Tokenizer

import __spark_entry__ as registered
from vintagemart.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, small, name):
    with connect(small) as db:
        assert differences(queries.QUERIES[name](spark, small), db, queries.ORACLES[name]) == []


def test_every_operator_and_the_pipeline_are_registered():
    names = registered.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLES) <= set(registered.oracle_sql())


@pytest.fixture(scope="module")
def stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = queries.table(spark, SF, "documents")
    out = {"documents": docs}
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, SF), name)
        out[name] = docs
    return out


def test_stages_return_documents(stages):
    first = stages["documents"].dtypes
    for name in ("quality", "near_duplicates", "secrets", "mix"):
        assert stages[name].dtypes == first, name


def test_quality_keeps_good_rows_unchanged(stages):
    assert stages["quality"].exceptAll(stages["documents"]).count() == 0
    assert 0 < stages["quality"].count() < stages["documents"].count()


def test_one_of_each_class_stays(stages):
    docs = stages["quality"].orderBy("doc_id").collect()
    classes = brute_classes([d.text for d in docs])
    assert sorted(r.doc_id for r in stages["near_duplicates"].collect()) == [docs[i].doc_id for i, _, c in classes if i == c]


def test_secrets_are_gone_and_no_document_is(stages):
    before = {r.doc_id: r for r in stages["near_duplicates"].collect()}
    after = {r.doc_id: r for r in stages["secrets"].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        assert not base_spans(r.text) and r.n_chars == len(r.text)
        if r.text != before[i].text:
            assert "<secret>" in r.text


def test_the_mix_repeats_whole_documents(stages):
    before = {r.doc_id: r for r in stages["secrets"].collect()}
    counts = {}
    for r in stages["mix"].collect():
        assert r == before[r.doc_id]
        counts[r.doc_id] = counts.get(r.doc_id, 0) + 1
    assert max(counts.values()) <= 2
    words = sum(len(before[i].text.encode().split()) * n for i, n in counts.items())
    assert words == pytest.approx(1.5 * sum(len((r.text or "").encode().split()) for r in before.values()), rel=0.05)


def test_tokens_are_those_of_the_library(stages):
    library = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    want = sorted((r.doc_id, library.encode(r.text, add_special_tokens=False).ids) for r in stages["mix"].collect())
    found = stages["tokens"].collect()
    assert sorted((r.doc_id, r.token_ids) for r in found) == want
    assert all(r.ids_sha256 == digest(" ".join(map(str, r.token_ids))) and r.n_tokens == len(r.token_ids) for r in found)


def test_odd_documents_pass_all_stages(spark, stages):
    """Nulls in any column, empty texts, repeated rows, and columns of names that stages use."""
    pipeline = importlib.import_module("corpus_pipeline")
    good = [r for r in stages["mix"].limit(3).collect()]
    rows_ = [tuple(r) for r in good] * 2 + [(None, good[0].text + " other end", None, None, None), (5, None, "en", "a", 0), (6, "", None, "a", 0)]
    docs = clashing(spark.createDataFrame(rows_, stages["documents"].schema))
    for name, stage in pipeline.STAGES:
        out = pipeline.written(stage(spark, docs, SF), name)
        if name != "tokens":
            assert out.columns == docs.columns, name
        docs = out
    assert {r.doc_id for r in docs.collect()} <= {r.doc_id for r in good} | {None}


def test_an_empty_table_passes_all_stages(spark, stages):
    pipeline = importlib.import_module("corpus_pipeline")
    docs = stages["documents"].limit(0)
    for name, stage in pipeline.STAGES:
        docs = pipeline.written(stage(spark, docs, SF), name)
        assert docs.count() == 0
    assert "token_ids" in docs.columns
