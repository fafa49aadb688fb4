from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import plan_of, tuples
from tidemark.operators import latest, timeline

FIRST = dt.date(2026, 4, 1)
D = [FIRST + dt.timedelta(days=i) for i in range(40)]

LOG = st.lists(
    st.tuples(st.sampled_from([None, 1, 2, 3]), st.integers(0, 14), st.integers(0, 99)), max_size=40
)
FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def brute_state(rows, day):
    """Newest row per key up to a day, by plain Python."""
    state = {}
    for key, changed, value in rows:
        if changed <= day and (key not in state or (changed, value) > state[key]):
            state[key] = (changed, value)
    return {(k, day, c, v) for k, (c, v) in state.items()}


@FEW
@given(rows=LOG, first=st.integers(0, 14), length=st.integers(0, 8))
def test_daily_state_equals_asof_of_each_day(spark, rows, first, length):
    rows = [(k, D[d], v) for k, d, v in rows]
    log = spark.createDataFrame(rows, "k int, d date, v int")
    start, end = D[first], D[first + length]
    state = timeline.daily_state(log, ["k"], "d", start, end, ["v"], state_day="day")
    found = {(r.k, r.day, r.d, r.v) for r in state.collect()}
    days = [start + dt.timedelta(days=i) for i in range(length + 1)]
    assert found == set().union(*[brute_state(rows, day) for day in days])
    assert state.count() == len(found)


def test_daily_state_of_one_day_is_latest_per_key_asof(frame):
    log = frame([(1, D[0], 5), (1, D[3], 6), (2, D[9], 7)], "k int, d date, v int")
    one = timeline.daily_state(log, ["k"], "d", D[4], D[4], state_day="day")
    assert tuples(one.drop("day")) == tuples(latest.latest_per_key_asof(log, ["k"], "d", D[4]))


def test_daily_state_keeps_change_day_column_of_same_name(frame):
    log = frame([(1, D[0], 5), (1, D[2], 6)], "k int, snapshot_date date, v int")
    state = timeline.daily_state(log, ["k"], "snapshot_date", D[1], D[2])
    assert tuples(state) == [(1, D[1], 5), (1, D[2], 6)]


def brute_close(rows):
    closed = []
    for key in {r[0] for r in rows}:
        versions = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        for here, following in zip(versions, [*versions[1:], None]):
            end = following[1] - dt.timedelta(days=1) if following else None
            closed.append((*here, end, end is None))
    return closed


@FEW
@given(rows=st.lists(st.tuples(st.sampled_from([None, "a", "b"]), st.integers(0, 10)), max_size=40))
def test_scd2_close_out(spark, rows):
    rows = [(k, D[d], i) for i, (k, d) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, start date, id int")
    closed = timeline.scd2_close_out(df, ["k"], "start", ["id"])
    key = lambda r: (r[0] or "", r[2])
    assert sorted([tuple(r) for r in closed.collect()], key=key) == sorted(brute_close(rows), key=key)


def test_scd2_intervals_do_not_overlap(frame):
    df = frame([("a", D[i], i) for i in (0, 3, 7, 20)], "k string, start date, id int")
    rows = timeline.scd2_close_out(df, ["k"], "start", ["id"]).orderBy("start").collect()
    assert [r.end_date for r in rows] == [D[2], D[6], D[19], None]
    assert [r.is_current for r in rows] == [False, False, False, True]


def test_scd2_window_runs_on_aggregated_rows(frame):
    df = frame([("a", D[0], 1)], "k string, start date, id int")
    plan = plan_of(timeline.scd2_close_out(df, ["k"], "start", ["id"]))
    window = plan.index("Window")
    assert "partial_max" in plan[window:], "the window must read the aggregate, not the table"


def test_bridge_maps_each_day_to_the_snapshot_in_effect(frame):
    slow = frame([(D[2], "a"), (D[2], "b"), (D[10], "c")], "month date, v string")
    bridged = timeline.bridge_to_days(slow, "month", "day", D[0], D[12])
    by_day = {}
    for row in bridged.collect():
        by_day.setdefault(row.day, set()).add((row.month, row.v))
    assert set(by_day) == set(D[2:13]), "days before the first snapshot are absent"
    assert by_day[D[2]] == by_day[D[9]] == {(D[2], "a"), (D[2], "b")}
    assert by_day[D[10]] == by_day[D[12]] == {(D[10], "c")}


def test_bridge_starts_in_the_middle_of_a_snapshot(frame):
    slow = frame([(D[0], "a"), (D[5], "b"), (D[30], "z")], "month date, v string")
    bridged = timeline.bridge_to_days(slow, "month", "day", D[7], D[8])
    assert tuples(bridged.select("day", "v")) == [(D[7], "b"), (D[8], "b")]


def test_bridge_without_snapshots_is_empty(frame):
    slow = frame([], "month date, v string")
    assert timeline.bridge_to_days(slow, "month", "day", D[0], D[3]).count() == 0


def test_stamp_days(frame):
    df = timeline.stamp_days(frame([(1,), (2,)], "k int"), "day", D[0], D[1])
    assert tuples(df) == [(1, D[0]), (1, D[1]), (2, D[0]), (2, D[1])]


def test_partition_days_are_sorted(frame):
    df = frame([(D[3],), (D[1],), (D[3],), (None,)], "d date")
    assert timeline.partition_days(df, "d") == [D[1], D[3]]
