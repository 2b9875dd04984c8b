"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import re

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from greenledger.registry.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, sf_dir, con, name):
    df = QUERIES[name](spark, sf_dir)
    problem, _rows = compare(df, con, ORACLES[name])
    assert problem == ""


WRITES = {"run_all", "run_aggregate", "run_generate_aggregate", "generate_all"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_plan_has_no_nested_loop_or_python(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoop|Python|Pandas", plan)


def test_entry_runs(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 1 and rows[0].total_cost > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
