"""The registered training-data queries against their SQL, and the pipeline stage by stage."""

import pytest

import corpus_pipeline
from compare import compare, connect
from leafmill.llm import language
from leafmill.llm.oracles import ORACLES
from leafmill.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, SF_DIR) == ""


@pytest.mark.parametrize("name", QUERIES.keys() - ORACLES.keys())
def test_query_covers_its_whole_table(spark, name):
    made = QUERIES[name](spark, SF_DIR)
    table, key = ("conversations", "conv_id") if name == "op13_conversation_repair" else ("documents", "doc_id")
    given = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key)
    if key == "conv_id":
        given = given.distinct()
    if name == "op1_temperature_mixing":  # takes documents several times or not at all
        assert made.count() > 0
    else:
        assert sorted(r[0] for r in made.select(key).collect()) == sorted(r[0] for r in given.collect())


def test_stages_keep_the_columns_and_only_given_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        made = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), f"test-{name}")
        assert made.columns == docs.columns, name
        after = {r.doc_id for r in made.select("doc_id").collect()}
        assert after and after <= before, name
        docs = made
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() == docs.count()


def test_language_stage_keeps_most_labelled_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang is not null and length(text) > 40")
    assert language.held_out() is not None
    assert corpus_pipeline.known_language(spark, docs, SF_DIR).count() >= 0.9 * docs.count()
