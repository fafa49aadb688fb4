"""Near vectors against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vector_dup
from tidemark.llm.vector_dup import distances, forest, may_visit, near_vectors, reach, spaced, unit


def brute(rows, cosine=0.93):
    def usable(row):
        i, v, label = row
        return i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    def linked(one, two):
        if not (usable(one) and usable(two)) or one[2] != two[2] or len(one[1]) != len(two[1]):
            return False
        dot, a, b = (sum(x * y for x, y in zip(p, q)) for p, q in ((one[1], two[1]), (one[1],) * 2, (two[1],) * 2))
        return dot / math.sqrt(a * b) >= cosine

    links = [[j for j in range(len(rows)) if j != i and linked(rows[i], rows[j])] for i in range(len(rows))]
    same = [[j for j in range(len(rows)) if rows[i][0] is not None and rows[j][0] == rows[i][0]] for i in range(len(rows))]
    out, seen = [None] * len(rows), set()
    for start in range(len(rows)):
        if start in seen:
            continue
        group, todo = {start}, [start]
        while todo:
            at = todo.pop()
            for j in links[at] + same[at]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen |= group
        least = min((rows[i][0] for i in group if rows[i][0] is not None), default=None)
        for i in group:
            out[i] = (rows[i][0], len(links[i]), least, rows[i][0] == least)
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in near_vectors(df, **options).collect()), key=str)


def clusters(n, width, seed, spread=0.06):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[draw.integers(12)] + draw.normal(size=width) * spread * draw.random() * 4
        rows.append((i * 3 % 1009, (v * draw.random()).tolist(), int(draw.integers(2)) if i % 3 else 0))
    return rows


@pytest.mark.parametrize("cell_rows", [4096, 40])
@pytest.mark.parametrize("kind", ["clusters", "even"])
def test_matches_all_pairs(spark, frame, kind, cell_rows, monkeypatch):
    monkeypatch.setattr(vector_dup, "BLOCK_ROWS", 50)
    rows = clusters(300, 6, 5) if kind == "clusters" else [(i, np.random.default_rng(i).normal(size=4).tolist(), 1) for i in range(300)]
    df = frame(rows, "vec_id long, embedding array<double>, label int")
    assert found(df, cell_rows=cell_rows) == brute(rows)


def test_edge_rows(spark, frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.5], 1), (2, [2.0, 1.0], 1), (3, [1.0, 0.5], 1), (3, [1.0, 0.5], 1), (4, [1.0, 0.5], 2), (5, [1.0, 0.5], None),
        (6, None, 1), (7, [], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [0.0, 0.0], 1), (12, [1.0], 1),
        (13, [-1.0, -0.5], 1), (None, [1.0, 0.5], 1), (14, [-1.0, -0.5], 1), (14, [0.0, 7.0], 1), (15, [0.0, 8.0], 1), (16, [1e200, 5e199], 1),
        (15, None, None), (2, [0.0, 0.0], 3), (17, [-0.0, 3.0], 1),
    ]
    df = frame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, class string, copies int")
    expected = brute(rows[:18] + rows[19:])
    assert [r for r in found(df) if r[0] != 16 and r[0] not in (1, 2, 3)] == [r for r in expected if r[0] not in (1, 2, 3)]
    # The very long vector links with the four that point its way.
    assert [r for r in found(df) if r[0] in (1, 2, 3, 16)] == sorted(
        [(1, 4, 1, True), (2, 4, 1, False), (2, 0, 1, False), (3, 4, 1, False), (3, 4, 1, False), (16, 4, 1, False)], key=str
    )


def test_threshold_is_met_exactly(spark, frame):
    rows = [(1, [1.0, 0.0], "a"), (2, [0.8, 0.6], "a"), (3, [0.6, 0.8], "b"), (4, [0.0, 1.0], "b"), (5, [3.0, 4.0], "c"), (6, [4.0, 3.0], "c")]
    df = frame(rows, "vec_id long, embedding array<double>, label string")
    for cosine in (0.8, 0.96, math.nextafter(0.96, 1)):
        assert found(df, cosine=cosine) == brute(rows, cosine)


def test_no_rows(spark, frame):
    assert found(frame([], "vec_id long, embedding array<float>, label int")) == []


def test_crowded_label_is_many_tasks(spark, frame, monkeypatch):
    """A third of all rows are copies, a third lie close together; no task holds more than two blocks."""
    monkeypatch.setattr(vector_dup, "BLOCK_ROWS", 64)
    draw = np.random.default_rng(2)
    rows = [(i, [1.0, 2.0, 3.0], 1) for i in range(400)]
    rows += [(400 + i, (np.array([3.0, 1.0, 0.0]) + draw.normal(size=3) * 0.1).tolist(), 1) for i in range(400)]
    rows += [(800 + i, draw.normal(size=3).tolist(), 1) for i in range(400)]
    df = frame(rows, "vec_id long, embedding array<double>, label int")
    sizes = []
    solve = vector_dup._tasks

    def counted(*given):
        tasks = solve(*given)
        sizes.append(tasks.groupBy("label", "width", "cell", "visits", "one", "two").count().agg(F.max("count")).first()[0])
        return tasks

    monkeypatch.setattr(vector_dup, "_tasks", counted)
    assert found(df, cell_rows=100) == brute(rows)
    assert sizes[0] <= 4 * 64


def test_bounds_prune_and_lose_nothing():
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(30, 16))
    rows = unit(np.vstack([centres[i % 30] + draw.normal(size=16) * 0.05 for i in range(900)]))
    pivots = spaced(rows[:200], 12, 0.3)
    away = distances(rows, pivots)
    home = away.argmin(axis=1)
    radii = np.array([away[home == c, c].max(initial=-1) for c in range(len(pivots))])
    goes = may_visit(away, home, pivots, radii, reach(0.93))
    pairs = np.argwhere(np.triu(rows @ rows.T >= 0.93, 1))
    apart = [(i, j) for i, j in pairs if home[i] != home[j]]
    assert all(goes[i, home[j]] or goes[j, home[i]] for i, j in apart)
    assert not any(goes[i, home[j]] and goes[j, home[i]] for i, j in apart)
    assert goes.sum() < 0.2 * len(rows) * len(pivots)


def test_forest():
    linked = np.zeros((4, 5), bool)
    linked[[0, 0, 2, 3], [1, 3, 3, 4]] = True
    rows, columns = forest(linked)
    assert rows.tolist() == [0, -1, 0, 1] and columns.tolist() == [-1, 0, -1, 0, 1]
