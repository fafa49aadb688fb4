"""k-means with all starts in one pass, against plain Python."""

from __future__ import annotations

import math
import random

import pytest

from tests.conftest import plan_of
from tidemark.operators import clustering

XY = ["x", "y"]


def lloyd(rows, centers):
    """Centres and cost where plain iterations from ``centers`` end."""
    while True:
        groups = [[] for _ in centers]
        for row in rows:
            groups[min(range(len(centers)), key=lambda i: (math.dist(row, centers[i]), i))].append(row)
        moved = [tuple(sum(c) / len(g) for c in zip(*g)) if g else old for g, old in zip(groups, centers)]
        if moved == centers:
            return centers, sum(math.dist(r, c) ** 2 for g, c in zip(groups, centers) for r in g)
        centers = moved


def uniform(frame, n=150):
    draw = random.Random(11)
    rows = [(draw.uniform(0, 10), draw.uniform(0, 10)) for _ in range(n)]
    return rows, frame(rows, "x double, y double").repartition(4)


def test_every_start_ends_where_plain_iterations_end(frame):
    rows, points = uniform(frame)
    seeds = clustering._seeded(points, XY, 3, 4, 42)
    fits = clustering.kmeans(points, XY, 3, 4, 42, 200, 0.0 + 1e-12)
    assert len({tuple(f.centers) for f in seeds}) > 1, "starts differ"
    for seed, fit in zip(seeds, fits):
        centers, cost = lloyd(rows, seed.centers)
        assert fit.settled and fit.cost == pytest.approx(cost)
        assert [x for c in fit.centers for x in c] == pytest.approx([x for c in centers for x in c])


def test_seeds_are_different_rows_in_any_row_order(frame):
    rows, points = uniform(frame, 40)
    repeated = frame((rows * 3)[::-1], "x double, y double").repartition(3)
    seeds = clustering._seeded(points, XY, 4, 3, 7)
    assert [f.centers for f in seeds] == [f.centers for f in clustering._seeded(repeated, XY, 4, 3, 7)]
    for fit in seeds:
        assert len(set(fit.centers)) == 4 and set(fit.centers) <= set(rows)


def test_passes_do_not_grow_with_the_number_of_starts(spark, frame):
    _, points = uniform(frame)
    jobs = []
    for starts in (1, 8):
        spark.sparkContext.setJobGroup(f"starts-{starts}", "")
        clustering.kmeans(points, XY, 3, starts, 42, 3, -1.0)  # never settles
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"starts-{starts}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_rows_are_combined_before_the_shuffle_without_a_sort(frame):
    _, points = uniform(frame)
    rows = clustering._by_start(points, XY, {0: clustering.Clustering([(0.0, 1.0), (2.0, 3.0)])})
    plan = plan_of(rows.groupBy("_start", "_to.label").sum("x"))
    assert "partial_sum" in plan and "Sort" not in plan


def test_one_center_and_one_row(frame):
    fits = clustering.kmeans(frame([(1.0, 2.0)] * 3, "x double, y double"), XY, 1, 2, 1, 9, 0.0)
    assert [(f.centers, f.cost, f.settled) for f in fits] == [([(1.0, 2.0)], 0.0, True)] * 2
