"""Corpus queries against their SQL definitions, and what their plans may hold."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.conftest import plan_of
from tidemark.llm.registry import ORACLES, QUERIES
from tools.check_oracle import compare, open_oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    connection = open_oracle(SF_DIR)
    yield connection
    connection.close()


def test_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {*(f"op{n}" for n in range(1, 14)), "pipeline"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, oracle, name):
    outcome, _ = compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name])
    assert outcome == "ok"


def test_mixing_runs_no_python_in_its_plan(spark):
    plan = plan_of(QUERIES["op4_mixing"](spark, SF_DIR))
    for step in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert step not in plan


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pipeline"}))
def test_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
