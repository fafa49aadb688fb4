from __future__ import annotations

import datetime as dt

from tests.conftest import plan_of, tuples
from tidemark.operators import latest

D = [dt.date(2026, 4, d) for d in range(1, 11)]


def test_newest_row_per_key_and_total_tiebreak(frame):
    rows = [(1, D[0], "a"), (1, D[1], "b"), (1, D[1], "c"), (2, D[0], "z"), (2, None, "later")]
    df = frame(rows, "k int, d date, v string")
    assert tuples(latest.latest_per_key(df, ["k"], ["d"])) == [(1, D[1], "c"), (2, D[0], "z")]


def test_null_keys_form_one_group(frame):
    df = frame([(None, D[0], "a"), (None, D[1], "b")], "k int, d date, v string")
    assert tuples(latest.latest_per_key(df, ["k"], ["d"])) == [(None, D[1], "b")]


def test_column_order_is_kept(frame):
    df = frame([("x", 1, D[0])], "v string, k int, d date")
    assert latest.latest_per_key(df, ["k"], ["d"]).columns == ["v", "k", "d"]


def test_asof_ignores_later_changes(frame):
    df = frame([(1, D[0], "a"), (1, D[4], "b"), (2, D[5], "c")], "k int, d date, v string")
    assert tuples(latest.latest_per_key_asof(df, ["k"], "d", D[3])) == [(1, D[0], "a")]


def test_latest_partition(frame):
    df = frame([(1, D[0]), (2, D[3]), (3, D[3]), (4, D[5])], "k int, d date")
    assert tuples(latest.latest_partition(df, "d", D[4])) == [(2, D[3]), (3, D[3])]
    assert latest.latest_partition(df, "d", D[0] - dt.timedelta(days=1)).count() == 0


def test_latest_partition_prunes_a_partitioned_table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame([(1, D[0]), (2, D[3])], "k int, d date").write.partitionBy("d").parquet(path)
    stored = spark.read.schema("k int, d date").parquet(path)
    plan = plan_of(latest.latest_partition(stored, "d", D[4]))
    assert "PartitionFilters: [isnotnull(d" in plan and "Subquery" in plan
    assert tuples(latest.latest_partition(stored, "d", D[4])) == [(2, D[3])]


def test_current_versions_takes_newest_start(frame):
    rows = [("p", D[0], True), ("p", D[2], True), ("p", D[5], False), ("q", D[1], True)]
    df = frame(rows, "n string, start date, is_current boolean")
    assert tuples(latest.current_versions(df, ["n"], "start")) == [("p", D[2], True), ("q", D[1], True)]


def test_map_side_combine(frame):
    df = frame([(1, D[0], "a")], "k int, d date, v string")
    plan = plan_of(latest.latest_per_key(df, ["k"], ["d"]))
    assert "partial_max" in plan and "Window" not in plan
