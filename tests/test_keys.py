from __future__ import annotations

import random

from tests.conftest import plan_of
from tidemark.operators.keys import surrogate_key


def test_matches_row_number_with_nulls_last_and_a_hot_key(frame):
    random.seed(7)
    rows = [(random.choice([None, 5, random.randint(0, 500)]), i) for i in range(3000)]
    df = frame(rows, "k int, id int").repartition(6)
    numbered = surrogate_key(df, "n", ["k", "id"], partitions=7)
    expected = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    found = [(r.k, r.id) for r in sorted(numbered.collect(), key=lambda r: r.n)]
    assert found == expected
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 3001))


def test_numbers_start_again_in_every_group(frame):
    random.seed(8)
    rows = [(random.choice(["x", "y", None]), random.randint(0, 10**6)) for _ in range(500)]
    numbered = surrogate_key(frame(rows, "g string, k int"), "n", ["k"], within=["g"], partitions=5)
    for group in ("x", "y", None):
        got = sorted([(r.n, r.k) for r in numbered.collect() if r.g == group])
        assert [n for n, _ in got] == list(range(1, len(got) + 1))
        assert [k for _, k in got] == sorted(k for _, k in got)


def test_equal_rows_still_get_different_numbers(frame):
    numbered = surrogate_key(frame([(1, "a")] * 50, "k int, v string"), "n", ["k"], partitions=4)
    assert sorted(r.n for r in numbered.collect()) == list(range(1, 51))


def test_reruns_agree_on_ties(frame):
    rows = [(1, f"v{i}") for i in range(200)]
    first = surrogate_key(frame(rows, "k int, v string").repartition(3), "n", ["k"])
    second = surrogate_key(frame(rows[::-1], "k int, v string").repartition(5), "n", ["k"])
    assert {(r.n, r.v) for r in first.collect()} == {(r.n, r.v) for r in second.collect()}


def test_empty_input(frame):
    assert surrogate_key(frame([], "k int"), "n", ["k"]).count() == 0


def test_no_single_task_and_no_window(frame):
    plan = plan_of(surrogate_key(frame([(1,)], "k int"), "n", ["k"]))
    assert "SinglePartition" not in plan and "Window" not in plan
