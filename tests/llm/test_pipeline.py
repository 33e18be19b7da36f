"""The corpus pipeline, stage by stage, and the operators' queries that have SQL."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import database, difference
from retally.llm import queries


def test_stages_hand_on_the_columns_of_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert 0.5 * before < docs.count() <= before
    packed = corpus_pipeline.run(spark, small).select("doc_id").distinct()
    assert {r[0] for r in packed.collect()} == {r[0] for r in docs.select("doc_id").collect()}


@pytest.mark.parametrize("name", sorted(queries.oracle()))
def test_equal_to_sql(spark, small, name):
    assert difference(entry.queries()[name](spark, small), database(small), entry.oracle_sql()[name]) is None
