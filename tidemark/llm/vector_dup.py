"""Near duplicates among vectors: an exact range join in a metric space.

Vectors of one label are compared by cosine. Brought to length 1, a cosine of at least c is a
distance of at most sqrt(2 - 2 c), and distances obey the triangle inequality. Equal vectors form
a class first. The classes of a large label are dealt to the cell of their nearest pivot, their
home. A vector also visits another cell if a resident of it may lie near enough: not if it is
farther from the pivot than the cell's radius and the range together, and not if it is farther
than the range from the plane between both pivots. Of two cells only one sends visitors to the
other, so every pair of vectors in reach meets once. Cells join independently: residents with residents,
residents with visitors, in blocks, so that a crowded cell is many tasks. A task gives for each
vector how many it links with, and a spanning forest of its links; never the links themselves.

The driver holds the pivots and their cells' radii, a bounded number. Where no bound holds, as
for vectors without clusters in many dimensions, every pair of a label is compared once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.components import components
from tidemark.llm.shipping import ship
from tidemark.scratch import materialize

COSINE = 0.93
CELL_ROWS = 4096  # classes of a label from which on it is dealt over cells, and about as many a cell
MOST_PIVOTS = 256  # cells that are crowded all the same are solved in blocks
PIVOT_SAMPLE = 4096  # classes, those with the smallest hashes, that pivots are chosen from
BLOCK_ROWS, BLOCK_NUMBERS = 4096, 1 << 20  # rows, and components, of one side of a task
TILE_ROWS = 512
CLOSE = 1e-9  # cosines as near as this to the least one are computed again, number by number

SPACE = ["label", "width"]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows brought to length 1; none may be all zero."""
    _, exponents = np.frexp(np.abs(rows).max(axis=1))
    rows = np.ldexp(rows, -exponents[:, None])
    return rows / np.sqrt((rows**2).sum(axis=1))[:, None]


def exact_cosines(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Cosines of pairs of rows, all sums taken from the first component to the last."""
    one, two = (np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None]) for x in (one, two))
    dot, a, b = (np.cumsum(x, axis=1)[:, -1] for x in (one * two, one * one, two * two))
    return dot / np.sqrt(a * b)


def reach(cosine: float) -> float:
    """The distance of unit vectors with that cosine, a little widened."""
    return float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-6


def spaced(sample: np.ndarray, n: int, apart: float) -> np.ndarray:
    """Up to ``n`` of the rows, in order, each farther than ``apart`` from those before it."""
    chosen = sample[:1]
    near = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < n:
        left = np.flatnonzero(near > apart * apart)
        if not len(left):
            break
        chosen = np.vstack([chosen, sample[left[:1]]])
        near = np.minimum(near, ((sample - chosen[-1]) ** 2).sum(axis=1))
    return chosen


def distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (rows @ pivots.T), 0))


def may_visit(away: np.ndarray, home: np.ndarray, pivots: np.ndarray, radii: np.ndarray, within: float) -> np.ndarray:
    """Which cells each vector (``away``: its distances to the pivots) visits."""
    own = away[np.arange(len(home)), home]
    between = distances(pivots, pivots)[home]
    plane = away**2 - own[:, None] ** 2 <= 2 * between * within + 1e-9
    ball = away <= radii + within
    cells = np.arange(len(pivots))
    # Of two cells the lower sends visitors if their numbers add up to an odd number, else the higher.
    sends = ((home[:, None] < cells) == ((home[:, None] + cells) % 2 == 1)) & (home[:, None] != cells)
    return plane & ball & sends


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a matrix of links, the number of the component of each row and of each column; -1: none."""
    across = np.ascontiguousarray(linked.T)
    rows, columns = np.full(len(linked), -1), np.full(len(across), -1)
    n = 0
    for start in np.flatnonzero(linked.any(axis=1)):
        if rows[start] >= 0:
            continue
        new = np.array([start])
        while len(new):
            rows[new] = n
            reached = np.flatnonzero(linked[new].any(axis=0) & (columns < 0))
            columns[reached] = n
            new = np.flatnonzero(across[reached].any(axis=0) & (rows < 0))
        n += 1
    return rows, columns


def _matrix(column: pa.Array, kind: str, width: int) -> np.ndarray:
    raw = b"".join(x.as_buffer().to_pybytes() for x in column)
    return np.frombuffer(raw, kind).reshape(-1, width).astype(float)


def _solve(table: pa.Table, kind: str, cosine: float) -> pa.Table:
    """Links of the left rows with the right ones; of the left ones among each other if there is no right one."""
    table = table.combine_chunks()
    width = table["width"][0].as_py()
    alone = table["one"][0].as_py() == table["two"][0].as_py() and not table["visits"][0].as_py()
    left = np.ones(table.num_rows, bool) if alone else np.asarray(table["is_left"])
    ids, copies = np.asarray(table["class"]), np.asarray(table["copies"])
    vectors = table["v"].combine_chunks()
    a = _matrix(vectors.filter(pa.array(left)), kind, width)
    b = a if alone else _matrix(vectors.filter(pa.array(~left)), kind, width)
    ids_a, copies_a = ids[left], copies[left]
    ids_b, copies_b = (ids_a, copies_a) if alone else (ids[~left], copies[~left])
    empty = {"class": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "other": pa.array([], pa.int64())}
    if not len(a) or not len(b):
        return pa.table(empty)
    unit_a, unit_b = unit(a), unit(b)
    linked = np.zeros((len(a), len(b)), bool)
    for low in range(0, len(a), TILE_ROWS):
        cosines = unit_a[low : low + TILE_ROWS] @ unit_b.T
        linked[low : low + TILE_ROWS] = cosines >= cosine
        at, to = np.nonzero(np.abs(cosines - cosine) < CLOSE)
        for part in range(0, len(at), 4096):
            i, j = at[part : part + 4096] + low, to[part : part + 4096]
            linked[i, j] = exact_cosines(a[i], b[j]) >= cosine
    if alone:  # rows and columns are the same vectors
        np.fill_diagonal(linked, False)
        np.fill_diagonal(linked, linked.any(axis=1))
    rows, columns = forest(linked)
    if alone:
        np.fill_diagonal(linked, False)
    roots = np.zeros(max(int(rows.max()), int(columns.max())) + 1, np.int64)
    found = np.flatnonzero(rows >= 0)
    roots[rows[found[::-1]]] = ids_a[found[::-1]]
    out = [(ids_a[found], (linked[found] @ copies_b).astype(np.int64), roots[rows[found]])]
    if not alone:
        found = np.flatnonzero(columns >= 0)
        out.append((ids_b[found], (linked.T[found] @ copies_a).astype(np.int64), roots[columns[found]]))
    return pa.table({name: pa.array(np.concatenate([x[i] for x in out])) for i, name in enumerate(empty)})


def _homes(classes: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """``classes`` with their home ``cell`` and their distance ``away`` from its pivot."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2048):
                batch = whole.slice(low, 2048)
                dealt = np.flatnonzero(np.asarray(batch.column("dealt")))
                cells, away = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
                if len(dealt):
                    far = distances(unit(_matrix(batch.column("v").take(pa.array(dealt)), kind, width)), pivots)
                    cells[dealt] = far.argmin(axis=1)
                    away[dealt] = far.min(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cells), pa.array(away)], names=[*batch.schema.names, "cell", "away"]
                )

    schema = T.StructType([*classes.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])
    return classes.mapInArrow(run, schema)


def _visits(homed: DataFrame, pivots: np.ndarray, radii: np.ndarray, within: float, kind: str) -> DataFrame:
    """``class`` and the ``cells`` it visits."""
    width = pivots.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for low in range(0, whole.num_rows, 2048):
                batch = whole.slice(low, 2048)
                rows = unit(_matrix(batch.column("v"), kind, width))
                goes = may_visit(distances(rows, pivots), np.asarray(batch.column("cell")), pivots, radii, within)
                of, cells = np.nonzero(goes)
                bounds = np.searchsorted(of, np.arange(len(goes) + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(cells.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column("class"), lists], names=["class", "cells"])

    return homed.where("dealt").select("class", "v", "cell").mapInArrow(run, "class long, cells array<int>")


def _numbers(column: str, n: str) -> F.Column:
    """A number from 0 to ``n`` - 1 that a class has by its hash."""
    return F.pmod(F.xxhash64(F.lit(column), "class"), F.col(n)).cast("long")


def _tasks(homed: DataFrame, visits: DataFrame | None) -> DataFrame:
    """Each class once for every task that it takes part in, under the key of the task."""
    rows = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_NUMBERS) / F.col("width"))))
    blocks = F.ceil(F.count(F.lit(1)) / F.first(rows))
    sizes = materialize(homed.groupBy(*SPACE, "cell").agg(blocks.alias("n_blocks")), "cell-sizes")
    keep = [*SPACE, "cell", "class", "copies", "v"]
    resident = homed.join(sizes, [*SPACE, "cell"]).withColumn("block", _numbers("resident", "n_blocks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    own = resident.withColumn("with", every).select(
        *keep,
        F.lit(False).alias("visits"),
        F.least("block", "with").alias("one"),
        F.greatest("block", "with").alias("two"),
        (F.col("block") <= F.col("with")).alias("is_left"),
    )
    if visits is None:
        return own
    to = visits.select("class", F.explode("cells").alias("to"))
    guests = homed.select(*SPACE, "class").join(to, "class").withColumnRenamed("to", "cell")
    crowds = materialize(guests.groupBy(*SPACE, "cell").agg(F.count(F.lit(1)).alias("n_guests")), "crowds")
    crowds = crowds.join(sizes, [*SPACE, "cell"])
    crowds = materialize(crowds.withColumn("n_parts", F.ceil(F.col("n_guests") / rows)), "crowded-cells")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_parts") - 1))
    hosts = resident.drop("n_blocks").join(crowds, [*SPACE, "cell"]).withColumn("part", parts)
    hosts = hosts.select(*keep, F.lit(True).alias("visits"), F.col("block").alias("one"), F.col("part").alias("two"), F.lit(True).alias("is_left"))
    moved = homed.drop("cell", "away").join(to.withColumnRenamed("to", "cell"), "class").join(crowds, [*SPACE, "cell"])
    moved = moved.withColumn("part", _numbers("guest", "n_parts")).withColumn("block", every)
    moved = moved.select(*keep, F.lit(True).alias("visits"), F.col("block").alias("one"), F.col("part").alias("two"), F.lit(False).alias("is_left"))
    return own.unionByName(hosts).unionByName(moved)


def link_classes(classes: DataFrame, kind: str, cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``class``, ``links`` and ``other`` from every task: partial counts and a class of the same component."""
    spark = classes.sparkSession
    ship(spark)
    sizes = materialize(classes.groupBy(*SPACE).agg(F.count(F.lit(1)).alias("n")), "label-sizes")
    large = sizes.where(F.col("n") > cell_rows).orderBy(F.col("n").desc(), "width").first()
    homed, visits = classes.withColumn("cell", F.lit(0)), None
    if large is not None:
        # Labels with vectors of the most frequent length are dealt; others are solved in blocks.
        dealt = sizes.select(*SPACE, ((F.col("n") > cell_rows) & (F.col("width") == large["width"])).alias("dealt"))
        marked = classes.join(dealt, SPACE)
        sample = marked.where("dealt").orderBy(F.xxhash64(F.lit("pivot"), "class")).limit(PIVOT_SAMPLE).select("v").collect()
        sample = unit(np.frombuffer(b"".join(bytes(r["v"]) for r in sample), kind).reshape(len(sample), -1).astype(float))
        within = reach(cosine)
        pivots = spaced(sample, min(MOST_PIVOTS, -(-large["n"] // cell_rows)), within)
        homed = materialize(_homes(marked, pivots, kind), "homes")
        radii = np.full(len(pivots), -1.0)
        for row in homed.where("dealt").groupBy("cell").agg(F.max("away").alias("radius")).collect():
            radii[row["cell"]] = row["radius"]
        visits = materialize(_visits(homed, pivots, radii + 1e-6, within, kind), "visits")
    tasks = _tasks(homed, visits)

    def solve(table: pa.Table) -> pa.Table:
        return _solve(table, kind, cosine)

    return tasks.groupBy(*SPACE, "cell", "visits", "one", "two").applyInArrow(solve, "class long, links long, other long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of each row (``vec_id``, ``embedding``, ``label``).

    Rows of one label, not null, are linked if their cosine in double precision is at least
    ``cosine`` (above 0). ``n_links`` counts the other rows linked directly, copies each by itself;
    ``component_id`` is the smallest ``vec_id`` that links lead to, and that row is kept. Null,
    empty and all-zero vectors, and those with null or non-finite components, link with nothing; so
    do vectors of different lengths, and rows with null ``vec_id`` (null component, kept). Rows that
    share a ``vec_id`` each get their row, and one component. Labels of any type that can be
    grouped. No rows: no rows. Other columns: ignored.
    """
    item = vectors.schema["embedding"].dataType.elementType
    item, kind = ("float", "<f4") if isinstance(item, T.FloatType) else ("double", "<f8")
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast(f"array<{item}>").alias("embedding"), "label")
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    usable = x.isNotNull() & (F.size(x) > 0) & ~F.coalesce(odd, F.lit(True)) & F.exists(x, lambda c: c != 0)
    usable = F.coalesce(usable & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    keys = [F.xxhash64(F.lit(seed), "label", "embedding").alias(name) for seed, name in ((1, "key_one"), (2, "key_two"))]
    named = rows.where(usable)
    packed = _packed(vectors.sparkSession, item)
    grouped = named.groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    grouped = grouped.select(
        F.monotonically_increasing_id().alias("class"),
        *keys,
        "label",
        F.size("embedding").alias("width"),
        packed("embedding").alias("v"),
        "copies",
        "least",
    )
    grouped = materialize(grouped, "vector-classes")
    found = link_classes(grouped.select("class", *SPACE, "v", "copies"), kind, cosine, cell_rows)
    found = materialize(found, "vector-links")
    told = grouped.select("key_one", "key_two", "class", "copies", "least")
    members = materialize(named.select("vec_id", *keys).join(told, ["key_one", "key_two"]), "vector-members")
    # An id that stands on several vectors joins their classes.
    several = members.groupBy("vec_id").agg(F.min("class").alias("a"), F.max("class").alias("b")).where("a < b").select("vec_id", "a")
    several = members.join(several, "vec_id").select("a", F.col("class").alias("b"))
    links = found.where("class <> other").select(F.col("class").alias("a"), F.col("other").alias("b")).unionByName(several)
    linked = materialize(components(links), "vector-components")
    least = linked.join(grouped.select("class", "least"), F.col("node") == F.col("class"))
    least = least.groupBy("component").agg(F.min("least").alias("least_of_all"))
    by_class = linked.join(least, "component").select(F.col("node").alias("class"), "least_of_all")
    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    facts = told.join(counts, "class", "left").join(by_class, "class", "left").select(
        "class",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least_of_all", "least").alias("component_id"),
    )
    facts = materialize(facts, "vector-facts")
    of_members = members.select("vec_id", "class").join(facts, "class").select("vec_id", "n_links", "component_id")
    rest = rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    # An id may stand on a row that takes part and on one that does not.
    rest = rest.join(of_members.groupBy("vec_id").agg(F.min("component_id").alias("known")), "vec_id", "left")
    rest = rest.select("vec_id", "n_links", F.coalesce("known", "component_id").alias("component_id"))
    return of_members.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _packed(spark, item: str):
    """Numbers of an array column as bytes."""
    kind = "<f4" if item == "float" else "<f8"
    ship(spark)

    @F.arrow_udf("binary")
    def pack(column: pa.Array) -> pa.Array:
        values = pa.py_buffer(np.ascontiguousarray(np.asarray(column.flatten()), kind))
        offsets = np.asarray(column.offsets).astype(np.int64)
        offsets = ((offsets - offsets[0]) * np.dtype(kind).itemsize).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), values])

    return pack
