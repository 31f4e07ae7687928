"""Every registered query with SQL gives the same rows as DuckDB; the others run."""

from __future__ import annotations

import pytest
from oracle import SF, assert_same

import corpus_pipeline
from textloom.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    assert_same(spark, QUERIES[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_whole_table(spark, name):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES[name](spark, SF).select("doc_id").toPandas()["doc_id"].tolist()
    assert sorted(got) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_entry_lists_the_queries():
    import __spark_entry__ as entry

    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5
