"""k-means from several starts at once: one aggregate over the points per step, for all starts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Center = tuple[float, ...]


@dataclass
class Clustering:
    """Centres of one start, the sum of squared distances to them, and whether they settled."""

    centers: list[Center]
    cost: float = float("inf")
    settled: bool = False


def squared_distance(columns: Sequence[str], center: Sequence[Column]) -> Column:
    """Squared distance of a row to a centre."""
    total = F.lit(0.0)
    for name, value in zip(columns, center):
        total = total + (F.col(name) - value) * (F.col(name) - value)
    return total


def nearest(columns: Sequence[str], centers: Sequence[Sequence[Column]], labels: Sequence[int]) -> Column:
    """``(distance, label)`` of the nearest centre; of equally near ones the smallest label."""
    found = [
        F.struct(squared_distance(columns, center).alias("distance"), F.lit(label).alias("label"))
        for center, label in zip(centers, labels)
    ]
    return F.least(*found) if len(found) > 1 else found[0]


def _by_start(points: DataFrame, columns: Sequence[str], fits: dict[int, Clustering]) -> DataFrame:
    """Each row once per start, with its nearest centre there as ``_to``, if there are any yet.

    Centres are the entries of one constant array, so all iterations run the same generated code.
    """
    numbers = range(len(next(iter(fits.values())).centers))
    entries = []
    for start, fit in fits.items():
        values = [f"{x!r}D AS c{i}_{j}" for i, center in enumerate(fit.centers) for j, x in enumerate(center)]
        entries.append(f"struct({', '.join([f'{start} AS start', *values])})")
    rows = points.select(*columns, F.explode(F.expr(f"array({', '.join(entries)})")).alias("_fit"))
    to = [[F.col(f"_fit.c{i}_{j}") for j in range(len(columns))] for i in numbers]
    nearby = [nearest(columns, to, numbers).alias("_to")] if to else []
    return rows.select(*columns, F.col("_fit.start").alias("_start"), *nearby)


def _seeded(points: DataFrame, columns: Sequence[str], k: int, starts: int, seed: int) -> list[Clustering]:
    """First centres: points drawn in proportion to their squared distance to those drawn before.

    A point's draw is an exponential variable, made from a hash of its coordinates, over its
    weight; the smallest draw wins. It does not depend on the order of rows, and points that are
    repeated are drawn like one. Each centre takes one aggregate, for all starts.
    """
    fits = {start: Clustering([]) for start in range(starts)}
    for step in range(k):
        bits = F.shiftrightunsigned(F.xxhash64(*columns, F.col("_start") + seed, F.lit(step)), 11)
        draw = -F.log((bits + 0.5) / float(1 << 53))
        if step:
            weight = F.col("_to.distance")
            draw = F.when(weight > 0, draw / weight).otherwise(F.lit(float("inf")))
        rows = _by_start(points, columns, fits).withColumn("_draw", draw)
        drawn = rows.groupBy("_start").agg(*[F.min_by(name, "_draw").alias(f"c{i}") for i, name in enumerate(columns)])
        for row in drawn.collect():  # one a start
            fits[row["_start"]].centers.append(tuple(row[f"c{i}"] for i in range(len(columns))))
    return list(fits.values())


def kmeans(
    points: DataFrame, columns: Sequence[str], k: int, starts: int, seed: int, iterations: int, tolerance: float
) -> list[Clustering]:
    """Cluster the rows ``starts`` times by ``columns`` (doubles without NULL), all starts side by side.

    An iteration is one aggregate: a row is sent to the nearest centre of each start that has not
    settled, and combined on the map side into one row per start and centre. A start has settled
    when no centre moved further than ``tolerance``. A centre without rows stays where it is.
    Needs at least one row, and at least ``k`` different ones for ``k`` different centres.
    """
    fits = _seeded(points, columns, k, starts, seed)
    for _ in range(iterations):
        moving = {start: fit for start, fit in enumerate(fits) if not fit.settled}
        if not moving:
            break
        sums = _by_start(points, columns, moving).groupBy("_start", F.col("_to.label").alias("label")).agg(
            F.sum("_to.distance").alias("cost"), *[F.avg(name).alias(f"c{i}") for i, name in enumerate(columns)]
        )
        found: dict[int, list] = {start: [] for start in moving}
        for row in sums.collect():  # at most starts times k rows
            found[row["_start"]].append(row)
        for start, fit in moving.items():
            fit.cost = sum(row["cost"] for row in found[start])
            moved = 0.0
            for row in found[start]:
                center = tuple(row[f"c{i}"] for i in range(len(columns)))
                before = fit.centers[row["label"]]
                moved = max(moved, sum((a - b) ** 2 for a, b in zip(center, before)) ** 0.5)
                fit.centers[row["label"]] = center
            fit.settled = moved <= tolerance
    return fits
