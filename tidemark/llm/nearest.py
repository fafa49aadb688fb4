"""Exact top-k inner products by a Voronoi join.

Vectors become points whose distances order as inner products do: a data vector gets one more
component that brings its length to the greatest of all, a query gets 0. Queries and data are
grouped by their nearest pivot. From summaries of the groups (the farthest query, the nearest data
points) follows a distance within which every query of a group has its k best; a data row goes to
a query group only if it may lie that near. Each group is solved by slices of its data and blocks of its
queries, and the slices' best are merged.

The summaries and pivots that the driver holds are bounded by the number of pivots. How much
the bounds prune depends on the data; where they prune nothing, each query meets every row once,
block by block, which is what an exact search has to do then.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shipping import ship
from tidemark.scratch import materialize

SCALE = 1024
MOST_PIVOTS = 32
PIVOT_SAMPLE = 1024  # rows, those with the smallest hashes, that pivots are chosen from
SLICE_BYTES = 16 << 20
BLOCK_QUERIES = 1024

GROUP = "cell int, slice long, block long, is_query boolean, vec_id long, v binary"


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of each component; null, non-finite and empty vectors are left out."""
    x = F.col("embedding")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    rows = vectors.where(x.isNotNull() & (F.size(x) > 0)).where(~F.coalesce(odd, F.lit(True)))
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale)))).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, shorter ones filled with zeros."""
    values, offsets = np.asarray(column.flatten()), np.asarray(column.offsets)
    offsets = offsets - offsets[0]
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - np.repeat(offsets[:-1], lengths)] = values
    return out


class Pivots:
    """Pivots as points, and distances to them."""

    def __init__(self, rows: np.ndarray, radius2: float):
        self.rows, self.radius2 = rows.astype(float), radius2
        self.lift = np.sqrt(np.maximum(radius2 - (self.rows**2).sum(1), 0))
        points = np.column_stack([self.rows, self.lift])
        self.apart = np.sqrt(np.maximum(((points[:, None] - points[None]) ** 2).sum(2), 0))

    def of_data(self, rows: np.ndarray) -> np.ndarray:
        lift = np.sqrt(np.maximum(self.radius2 - (rows.astype(float) ** 2).sum(1), 0))
        return np.sqrt(np.maximum(2 * self.radius2 - 2 * (rows @ self.rows.T + np.outer(lift, self.lift)), 0))

    def of_queries(self, rows: np.ndarray) -> np.ndarray:
        own = (rows.astype(float) ** 2).sum(1)
        return np.sqrt(np.maximum(own[:, None] + self.radius2 - 2 * (rows @ self.rows.T), 0))


def spread(sample: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` rows of the sample, each farthest from those before it."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(1).astype(float)
    while len(chosen) < min(n, len(sample)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _summaries(rows: DataFrame, pivots: Pivots, width: int, k: int) -> tuple[dict[int, list], dict[int, tuple]]:
    """The ``k`` smallest distances of each data group; the largest and the number of each query group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near: dict[int, np.ndarray] = {}
        far: dict[int, tuple[float, int]] = {}
        for batch in batches:
            matrix = _matrix(batch.column("v"), width)
            asks = np.asarray(batch.column("is_query"))
            distances = pivots.of_data(matrix)
            cells = distances.argmin(1)
            own = distances[np.arange(len(cells)), cells]
            for cell in np.unique(cells):
                smallest = np.sort(np.append(near.get(cell, []), own[cells == cell]))
                near[cell] = smallest[:k]
            distances = pivots.of_queries(matrix[asks])
            cells = distances.argmin(1)
            own = distances[np.arange(len(cells)), cells]
            for cell in np.unique(cells):
                largest, n = far.get(cell, (0.0, 0))
                far[cell] = max(largest, float(own[cells == cell].max())), n + int((cells == cell).sum())
        out = [(int(c), False, float(d), 1) for c, ds in near.items() for d in ds]
        out += [(int(c), True, d, n) for c, (d, n) in far.items()]
        columns = list(zip(*out)) if out else [()] * 4
        types = [pa.int32(), pa.bool_(), pa.float64(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=["cell", "is_query", "distance", "n"]
        )

    found = rows.mapInArrow(run, "cell int, is_query boolean, distance double, n long")
    found = found.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(1024)))
    smallest = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    near = found.where("NOT is_query").groupBy("cell", "part").agg(
        F.slice(F.array_sort(F.collect_list("distance")), 1, k).alias("near")
    )
    near = near.groupBy("cell").agg(smallest.alias("near")).collect()
    far = found.where("is_query").groupBy("cell").agg(F.max("distance"), F.sum("n")).collect()
    return {r["cell"]: r["near"] for r in near}, {r["cell"]: (r[1], r[2]) for r in far}


def reaches(pivots: Pivots, near: dict[int, list], far: dict[int, tuple], k: int) -> np.ndarray:
    """For each pivot, how far from it a data point may lie and still be among the k best of one of its queries.

    -1 for pivots without queries. ``near`` must hold the distances of the k nearest points.
    """
    out = np.full(len(pivots.rows), -1.0)
    for cell, (radius, _) in far.items():
        upper = sorted(radius + pivots.apart[cell, other] + d for other, ds in near.items() for d in ds)
        out[cell] = math.inf if len(upper) < k else upper[k - 1] + radius
    return out * (1 + 1e-9) + np.where(out >= 0, 1e-6 * math.sqrt(pivots.radius2) + 1e-6, 0)


def _deal(rows: DataFrame, pivots: Pivots, width: int, reach: np.ndarray, n_slices: int, n_blocks: dict[int, int]) -> DataFrame:
    """Queries to every slice of their group, data rows to one slice of each group they may matter to."""

    def emit(cell, piece, block, is_query, ids, vectors):
        data = pa.py_buffer(np.ascontiguousarray(vectors, "<i8"))
        at = pa.py_buffer(np.arange(len(vectors) + 1, dtype=np.int32) * np.int32(8 * width))
        same = pa.Array.from_buffers(pa.binary(), len(vectors), [None, at, data])
        columns = [pa.array(cell, pa.int32()), pa.array(piece, pa.int64()), pa.array(block, pa.int64())]
        columns += [pa.array(np.full(len(vectors), is_query)), ids, same]
        return pa.RecordBatch.from_arrays(columns, names=["cell", "slice", "block", "is_query", "vec_id", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2048):
                batch = whole.slice(low, 2048)
                matrix, ids = _matrix(batch.column("v"), width), batch.column("vec_id")
                mark = np.asarray(batch.column("mark")).astype(np.int64)
                piece = mark % n_slices
                distances = pivots.of_data(matrix)
                for cell in np.flatnonzero(reach >= 0):
                    take = np.flatnonzero(distances[:, cell] <= reach[cell])
                    for block in range(n_blocks[cell]):
                        n = len(take)
                        yield emit(np.full(n, cell), piece[take], np.full(n, block), False, ids.take(pa.array(take)), matrix[take])
                asks = np.flatnonzero(np.asarray(batch.column("is_query")))
                if len(asks):
                    cells = pivots.of_queries(matrix[asks]).argmin(1)
                    blocks = (mark[asks] // n_slices) % np.array([n_blocks.get(int(c), 1) for c in cells])
                    for piece_no in range(n_slices):
                        yield emit(cells, np.full(len(asks), piece_no), blocks, True, ids.take(pa.array(asks)), matrix[asks])

    return rows.mapInArrow(run, GROUP)


def _solve(table: pa.Table, width: int, k: int) -> pa.Table:
    """The k best rows of one slice for each query of one block."""
    table = table.combine_chunks()
    flags = np.asarray(table["is_query"])

    def part(chosen):
        some = table.filter(pa.array(chosen))
        column = some["v"].combine_chunks() if isinstance(some["v"], pa.ChunkedArray) else some["v"]
        raw = b"".join(x.as_buffer().to_pybytes() for x in column) if len(column) else b""
        return some["vec_id"].to_pandas().astype("Int64"), np.frombuffer(raw, "<i8").reshape(-1, width)

    query_ids, asked = part(flags)
    if len(asked):
        _, once = np.unique(np.column_stack([query_ids.to_numpy(np.int64), asked]), axis=0, return_index=True)
        query_ids, asked = query_ids.iloc[once], asked[once]
    data_ids, data = part(~flags)
    numbers = data_ids.fillna(np.iinfo(np.int64).max).to_numpy(np.int64)
    order = np.argsort(numbers, kind="stable")
    numbers, data = numbers[order], data[order]
    nulls = data_ids.isna().to_numpy()[order]
    largest = max((float(np.abs(x).max()) for x in (asked, data) if x.size), default=0.0)
    exact = width * largest * largest < 2**53
    out_query, out_id, out_score, out_null = [], [], [], []
    for query_id, vector in zip(query_ids.to_numpy(np.int64) if len(query_ids) else [], asked):
        scores = (data.astype(float) @ vector.astype(float)).astype(np.int64) if exact else data @ vector
        own = (numbers == query_id) & ~nulls
        places = np.flatnonzero(~own)
        scores = scores[places]
        if len(scores) > k:
            limit = np.partition(scores, len(scores) - k)[len(scores) - k]
            places, scores = places[scores >= limit], scores[scores >= limit]
        best = np.argsort(-scores, kind="stable")[:k]
        out_query += [query_id] * len(best)
        out_id.append(numbers[places[best]])
        out_null.append(nulls[places[best]])
        out_score.append(scores[best])
    ids = np.concatenate(out_id) if out_id else np.zeros(0, np.int64)
    hidden = np.concatenate(out_null) if out_null else np.zeros(0, bool)
    return pa.table(
        {
            "query_id": pa.array(out_query, pa.int64()),
            "vec_id": pa.array(ids, pa.int64(), mask=hidden),
            "score": pa.array(np.concatenate(out_score) if out_score else ids, pa.int64()),
        }
    )


def top_k(vectors: DataFrame, is_query: str, k: int = 10, scale: int = SCALE, most_pivots: int = MOST_PIVOTS) -> DataFrame:
    """The ``k`` highest inner products of each query with all other rows.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` is a condition on ``vec_id``. Gives
    ``query_id``, ``rank`` from 1, ``vec_id``, ``score``; ties go to the smaller ``vec_id``.
    Null vectors, and those with null or non-finite components, take no part; nor do empty ones.
    Shorter vectors count as filled with zeros. Null ``vec_id``: never a query, last among ties.
    Rows with a query's id are that query's own; rows that repeat a query entirely ask once, other
    rows with its id ask as well, into one ranking. Fewer than ``k`` rows: all. No rows: no rows.
    Scores must fit 64 bits. Other columns: ignored.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = whole_vectors(vectors, scale)
    squares = F.aggregate("v", F.lit(0.0), lambda total, c: total + c.cast("double") * c.cast("double"))
    rows = rows.select(
        "vec_id",
        "v",
        F.coalesce(F.expr(is_query), F.lit(False)).alias("is_query"),
        F.shiftrightunsigned(F.xxhash64("vec_id", "v"), 1).alias("mark"),
    )
    rows = materialize(rows, "whole-vectors")
    n, n_queries, width, radius2 = rows.agg(
        F.count(F.lit(1)), F.sum(F.col("is_query").cast("long")), F.max(F.size("v")), F.max(squares)
    ).first()
    schema = "query_id long, rank int, vec_id long, score long"
    if not n_queries or n < 2:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy("mark").limit(PIVOT_SAMPLE).select("v").collect()
    sample = np.array([r["v"] + [0] * (width - len(r["v"])) for r in sample], np.int64)
    pivots = Pivots(spread(sample, max(1, min(most_pivots, math.isqrt(n_queries)))), radius2)
    # A query's own rows are no answers; its k best are among the k nearest besides them.
    most_own = rows.where("is_query").groupBy("vec_id").count().agg(F.max("count")).first()[0]
    near, far = _summaries(rows, pivots, width, k + most_own)
    reach = reaches(pivots, near, far, k + most_own)
    n_slices = max(1, -(-n * width * 8 // SLICE_BYTES))
    n_blocks = {cell: max(1, -(-count // BLOCK_QUERIES)) for cell, (_, count) in far.items()}
    dealt = _deal(rows, pivots, width, reach, n_slices, n_blocks)

    def solve(table: pa.Table) -> pa.Table:
        return _solve(table, width, k)

    found = dealt.groupBy("cell", "slice", "block").applyInArrow(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
