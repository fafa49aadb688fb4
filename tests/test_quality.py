from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import tuples
from tidemark.operators import quality as q
from tidemark.plans.declared_tests import DECLARED
from tidemark.schemas import table_schema

D = [dt.date(2026, 4, d) for d in range(1, 10)]


def test_null_counts_in_one_pass(frame):
    df = frame([(1, None), (None, None), (2, "x")], "a int, b string")
    assert tuples(q.null_counts(df)) == [("a", 1), ("b", 2)]


def test_nulls_are_equal_in_unique_combinations(frame):
    df = frame([(None, 1), (None, 1), (1, 1), (1, 2)], "a int, b int")
    assert tuples(q.duplicate_groups(df, ["a", "b"])) == [(None, 1, 2)]


def test_report_and_severities(frame):
    df = frame([(1, None), (1, "x"), (2, "y")], "a int, b string")
    tests = [q.NotNull("a"), q.NotNull("b", "warn"), q.UniqueCombination(("a",)), q.UniqueCombination(("a", "b"))]
    report = tuples(q.audit(df, "t", tests))
    assert report == [
        ("t", "not_null", "a", "error", 0, "pass"),
        ("t", "not_null", "b", "warn", 1, "warn"),
        ("t", "unique_combination", "a", "error", 1, "fail"),
        ("t", "unique_combination", "a,b", "error", 0, "pass"),
    ]


def test_same_column_with_two_severities_is_reported_per_declaration(frame):
    df = frame([(None,)], "a int")
    assert [r.status for r in q.audit(df, "t", [q.NotNull("a", "warn")]).collect()] == ["warn"]


def test_enforce_raises_on_errors_only(frame):
    df = frame([(1, None), (1, "x")], "a int, b string")
    assert len(q.enforce(q.audit(df, "t", [q.NotNull("b", "warn"), q.NotNull("a")]))) == 2
    with pytest.raises(q.DataTestFailure, match=r"t: unique_combination\(a\) 1"):
        q.enforce(q.audit(df, "t", [q.UniqueCombination(("a",))]))


def test_rowcount_drift(frame):
    rows = [(D[0],)] * 10 + [(D[1],)] * 12 + [(D[2],)] * 13 + [(D[4],)] * 13
    found = {r.day: (r.row_count, r.previous_count, r.passed) for r in q.rowcount_drift(frame(rows, "d date"), "d").collect()}
    assert found == {
        D[0]: (10, 0, False),  # no day before counts as one row
        D[1]: (12, 10, True),
        D[2]: (13, 12, True),
        D[4]: (13, 0, False),
    }


def test_declared_tests_are_complete_and_name_real_columns(spark):
    not_null = [t for ts in DECLARED.values() for t in ts if isinstance(t, q.NotNull)]
    unique = [t for ts in DECLARED.values() for t in ts if isinstance(t, q.UniqueCombination)]
    assert (len(not_null), sum(t.severity == "warn" for t in not_null)) == (39, 4)
    assert (len(unique), sum(t.severity == "warn" for t in unique)) == (11, 2)
    for table, tests in DECLARED.items():
        names = set(table_schema(table).names)
        for test in tests:
            assert set(test.columns if isinstance(test, q.UniqueCombination) else [test.column]) <= names
