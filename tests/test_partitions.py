from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tidemark.operators import partitions as p

D = [dt.date(2026, 4, 1) + dt.timedelta(days=i) for i in range(30)]


def inventory(frame, pairs):
    return frame(pairs, "table_name string, day date")


def test_inventory_and_counts(frame):
    a = frame([(D[0],), (D[0],), (D[2],)], "snapshot_date date")
    b = frame([(D[0],)], "snapshot_date date")
    assert tuples(p.partition_inventory({"a": a, "b": b})) == [("a", D[0]), ("a", D[2]), ("b", D[0])]
    counted = [tuple(r) for r in p.partition_row_counts({"b": b, "a": a}).collect()]
    assert counted == [("a", D[0], 2), ("a", D[2], 1), ("b", D[0], 1)]


def test_spine_to_last_day_or_given_end(frame):
    df = frame([(D[3],), (D[0],)], "d date")
    assert tuples(p.date_spine(df, "d")) == [(d,) for d in D[:4]]
    assert tuples(p.date_spine(df, "d", F.lit(D[1]))) == [(D[0],), (D[1],)]
    assert p.date_spine(df, "d", F.lit(D[0] - dt.timedelta(days=1))).count() == 0
    assert p.date_spine(df.where("false"), "d").count() == 0


def test_recent_partitions(frame):
    inv = inventory(frame, [("a", d) for d in D[:10]] + [("b", D[9])])
    assert tuples(p.recent_partitions(inv, 7)) == [(d,) for d in D[3:10]]


def test_missing_partitions_inside_the_window_only(frame):
    # The gap on D[1] is eight days old on D[9] and falls outside the window.
    inv = inventory(frame, [("a", d) for d in D[:10] if d not in (D[1], D[5])] + [("b", D[9])])
    found = tuples(p.missing_partitions(inv, D[9], 7))
    assert [r for r in found if r[0] == "a"] == [("a", D[5])]
    assert [r[1] for r in found if r[0] == "b"] == D[3:9]


def test_unbuilt_partitions(frame):
    candidates = frame([(D[0],), (D[1],), (D[1],)], "day date")
    built = frame([(D[0],)], "day date")
    assert tuples(p.unbuilt_partitions(candidates, built)) == [(D[1],)]


def test_due_partitions_of_any_input(frame):
    inv = inventory(frame, [("a", d) for d in D[:5]] + [("b", D[7]), ("c", D[9]), ("built", D[4])])
    candidates = p.days_of_any(inv, ["a", "b"])
    assert tuples(candidates) == [(d,) for d in [*D[:5], D[7]]]
    due = p.due_partitions(candidates, p.days_of_any(inv, ["built"]), recent=4)
    assert tuples(due) == [(D[2],), (D[3],), (D[7],)]


def test_readiness_needs_every_exact_and_covering_slow_inputs(frame):
    exact = inventory(frame, [("a", d) for d in D[:6]] + [("b", d) for d in D[2:8]])
    slow = inventory(frame, [("m", D[4]), ("m", D[20]), ("n", D[0])])
    ready = lambda *args: tuples(p.partition_readiness(*args))
    assert ready(exact, ["a", "b"], slow) == [(d,) for d in D[2:6]]
    assert ready(exact, ["a", "b"], slow, ["n"]) == [(d,) for d in D[2:6]]
    assert ready(exact, ["a", "b"], slow, ["m", "n"]) == [(D[4],), (D[5],)]
    assert ready(exact, ["a", "b", "absent"], slow) == []
    assert ready(exact, ["a", "b"], slow, ["absent"]) == []


@pytest.mark.parametrize(
    ("rule", "now", "oldest"),
    [
        (p.LANDING_DAILY, dt.datetime(2026, 4, 10, 9, 0), dt.datetime(2026, 4, 9, 9, 0)),
        (p.LANDING_DAILY, dt.datetime(2026, 4, 10, 8, 59), dt.datetime(2026, 4, 8, 9, 0)),
        (p.MODELS, dt.datetime(2026, 4, 10, 12, 0), dt.datetime(2026, 4, 9, 10, 0)),
        (p.ML, dt.datetime(2026, 4, 10, 10, 30), dt.datetime(2026, 4, 8, 11, 0)),
        (p.LANDING_MONTHLY, dt.datetime(2026, 4, 10, 0, 0), dt.datetime(2026, 3, 5, 9, 0)),
        (p.LANDING_MONTHLY, dt.datetime(2026, 3, 2, 8, 0), dt.datetime(2026, 1, 5, 9, 0)),
    ],
)
def test_oldest_allowed_timestamp(rule, now, oldest):
    assert rule.oldest_allowed(now) == oldest


def test_freshness_status(frame):
    now = dt.datetime(2026, 4, 10, 9, 30)
    fresh = frame([(dt.datetime(2026, 4, 9, 9, 0),), (None,)], "ts timestamp_ntz")
    stale = frame([(dt.datetime(2026, 4, 9, 8, 59),)], "ts timestamp_ntz")
    report = p.freshness_audit(
        {
            "fresh": (fresh, "ts", p.LANDING_DAILY),
            "stale": (stale, "ts", p.LANDING_DAILY),
            "none": (stale.where("false"), "ts", p.LANDING_DAILY),
        },
        now,
    )
    assert {r.table_name: r.status for r in report.collect()} == {
        "fresh": "PASS", "stale": "FAIL", "none": "FAIL"
    }
