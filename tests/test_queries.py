"""Every registered query against DuckDB, on the smallest test tables."""

from __future__ import annotations

import pytest
from compare import duck, duck_rows, spark_rows

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()
# Hundreds of rounds of short jobs; the same seven models run together in margin_verdicts.
SLOW = {
    "predict_gbt", "all_predictions", "accuracy_table", "score_links",
    "margin_gbt", "margin_all_predictions", "margin_accuracy_table",
}
LLM = set()  # those have their own tests, as they may be absent
if entry_point._llm is not None:
    LLM = set(entry_point._llm.queries()) | {"pipeline"}


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(ORACLES) - LLM - SLOW))
def test_query_equals_oracle(spark, sf_dir, connection, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == duck_rows(connection, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW - LLM))
def test_query_without_oracle_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
