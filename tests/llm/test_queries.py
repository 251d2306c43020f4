"""The registered queries on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

import comparison

import __spark_entry__ as registry
from splitmetrics.llm import queries

FOLDER = "/root/testdata/sf0.001"


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.queries())
    assert numbers == list(range(1, 14))
    assert set(queries.queries()) | {"pipeline"} <= set(registry.queries())


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_expected_sql(spark, name):
    found = comparison.differences(
        queries.queries()[name](spark, FOLDER), comparison.duck(FOLDER), queries.oracle_sql()[name]
    )
    assert found is None


ON_DOCUMENTS = [n for n in queries.queries() if n.split("_")[0] not in ("op1", "op11", "op13")]


@pytest.mark.parametrize("name", ON_DOCUMENTS)
def test_query_has_all_documents(spark, name):
    ids = {r["doc_id"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()}
    found = queries.queries()[name](spark, FOLDER).select("doc_id").collect()
    assert {r["doc_id"] for r in found} == ids
    assert len(found) == len(ids) or name in ("op9_token_shards", "op10_packing")
