"""Every registered query against its SQL definition, and the shape of the plans."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as entry
from tests.conftest import plan_of
from tidemark.queries import ORACLES, QUERIES
from tools.check_oracle import compare, open_oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables are absent")

# Queries whose method has no SQL counterpart, and those that fit a model while the frame is built.
WITHOUT_SQL: set[str] = set()


@pytest.fixture(scope="module")
def oracle():
    connection = open_oracle(SF_DIR)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, oracle, name):
    outcome, _ = compare(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name])
    assert outcome == "ok"


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


LAZY = sorted(set(QUERIES) - WITHOUT_SQL)


@pytest.mark.parametrize("name", LAZY)
def test_plan_has_no_cartesian_step_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert step not in plan


@pytest.mark.parametrize("name", LAZY)
def test_single_partition_steps_only_merge_partial_aggregates(spark, name):
    """One task may receive one partial result per task of a global aggregate, never rows."""
    lines = plan_of(QUERIES[name](spark, SF_DIR)).splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[number + 1]
            assert re.search(r"Aggregate\(keys=\[\], functions=\[.*(partial|merge)_", below), below


def test_scans_are_pruned_to_the_columns_in_use(spark):
    plan = plan_of(QUERIES["top_customers"](spark, SF_DIR))
    lineitem = next(line for line in plan.splitlines() if "lineitem.parquet" in line)
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in lineitem
    assert "TakeOrderedAndProject" in plan


def test_as_of_filter_reaches_the_scan(spark):
    plan = plan_of(QUERIES["latest_per_key_asof"](spark, SF_DIR))
    assert "LessThan(ts,2024-01-16" in plan


def test_partition_filter_selects_directories(spark):
    plan = plan_of(QUERIES["partition_scan"](spark, SF_DIR))
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ = 2024-01-15\)\]", plan)
