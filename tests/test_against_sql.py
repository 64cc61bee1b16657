"""Every query with a SQL counterpart, compared value by value."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from compare_with_sql import compare, connect

from conftest import MEDIUM, SMALL

SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(MEDIUM)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    _, _, verdict = compare(spark, con, MEDIUM, name, SQL[name])
    assert verdict == "equal"


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", ["diet_plan_share", "stratified_split", "box_summary", "results_long"])
def test_tiny_tables(spark, name):
    _, _, verdict = compare(spark, connect(SMALL), SMALL, name, SQL[name])
    assert verdict == "equal"


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_reload_and_stream_queries_report_no_difference(spark):
    assert contract.queries()["model_reload"](spark, MEDIUM).first()["changed"] == 0
    row = contract.queries()["stream_model_scoring"](spark, MEDIUM).first()
    assert row["different"] == 0 and row["n"] == 1500
