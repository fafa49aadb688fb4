"""Top-k against a full product."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.llm.nearest import Pivots, reaches, spread, top_k


def brute(rows, k, step=10):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for query_id, q in kept:
        if query_id is None or query_id % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i is None, i or 0, i) for i, v in kept if i != query_id)
        out += [(query_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(df, k=5):
    return sorted(tuple(r) for r in top_k(df, "vec_id % 10 = 0", k=k).collect())


@pytest.mark.parametrize("kind", ["clusters", "uniform", "lengths"])
def test_random_vectors(spark, frame, kind):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(6, 8))
    rows = []
    for i in range(700):
        v = draw.normal(size=8) * 0.02 + centres[i % 6] if kind == "clusters" else draw.normal(size=8)
        v = v * (draw.random() * 5 if kind == "lengths" else 1 / np.linalg.norm(v))
        rows.append((i, v.tolist()))
    assert found(frame(rows, "vec_id long, embedding array<double>")) == brute(rows, 5)


def test_edge_rows(spark, frame):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (10, [1.0, 0.5]), (20, None), (30, []), (40, [nan, 1.0]), (50, [inf, 1.0]), (60, [None, 1.0]),
        (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [2.0]), (4, [0.5, 0.5, 3.0]), (None, [1.0, 0.5]), (5, [-1.0, 0.0]),
    ]
    df = frame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, v string, mark int")
    assert found(df) == brute(rows, 5)


def test_repeated_queries_ask_once(spark, frame):
    rows = [(0, [1.0, 0.0])] * 3 + [(i, [math.cos(i), math.sin(i)]) for i in range(1, 30)]
    expected = brute([(0, [1.0, 0.0])] + rows[3:], 5)
    assert [r for r in found(frame(rows, "vec_id long, embedding array<double>")) if r[0] == 0] == [r for r in expected if r[0] == 0]


def test_no_rows_and_no_queries(spark, frame):
    schema = "vec_id long, embedding array<float>"
    assert top_k(frame([], schema), "vec_id % 10 = 0").count() == 0
    assert top_k(frame([(1, [1.0]), (2, [1.0])], schema), "vec_id % 10 = 0").count() == 0


def test_bounds_reach_the_best(spark):
    draw = random.Random(1)
    turns = [math.pi * (i % 3) * 2 / 3 + draw.uniform(-0.05, 0.05) for i in range(300)]
    data = np.array([[math.floor(1000 * f(t)) for f in (math.cos, math.sin)] for t in turns])
    radius2 = float((data**2).sum(1).max())
    pivots = Pivots(spread(data[:100], 7), radius2)
    distances, asked = pivots.of_data(data), pivots.of_queries(data[:50])
    cells, groups = distances.argmin(1), asked.argmin(1)
    near = {c: sorted(distances[cells == c, c])[:4] for c in range(len(pivots.rows))}
    far = {c: (asked[groups == c, c].max(), 1) for c in set(groups.tolist())}
    reach = reaches(pivots, near, far, 4)
    pruned = 0
    for i in range(50):
        best = np.argsort(-(data @ data[i]), kind="stable")[:4]
        assert (distances[best, groups[i]] <= reach[groups[i]]).all()
        pruned += (distances[:, groups[i]] > reach[groups[i]]).sum()
    assert pruned > 0
