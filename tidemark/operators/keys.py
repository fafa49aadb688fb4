"""Dense surrogate keys without pulling the table into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialize

# Rows of one partition are numbered in the low 33 bits of monotonically_increasing_id.
ROW_BITS = 33


def surrogate_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    within: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Number rows 1..n in the order of ``order_by``, NULLs last, per ``within`` group.

    Same result as a ``row_number`` over the whole table, but the sort is spread by range
    over all tasks. The sorted rows are written once, which pins the range bounds; the
    row count of each range is then turned into the number its first row starts from.
    Rows with equal ``order_by`` are ordered by a hash of their other columns, so reruns agree
    and a frequent value is split over ranges; only the sort columns are sampled.
    """
    rest = [c for c in df.columns if c not in {*order_by, *within}]
    order = [F.col(c).asc_nulls_last() for c in [*within, *order_by]]
    order += [F.xxhash64(*rest).asc()] if rest else []
    spark = df.sparkSession
    # Without a number the ranges follow the size of the data: small neighbours are merged.
    placed = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = placed.sortWithinPartitions(*order)
    stored = materialize(placed.withColumn("_seq", F.monotonically_increasing_id()), "keys")
    part = F.shiftright(F.col("_seq"), ROW_BITS)

    # One row per range, plus one per group boundary inside a range.
    counted = stored.groupBy(*within, part.alias("_part")).agg(
        F.min("_seq").alias("first"), F.count(F.lit(1)).alias("n")
    )
    if within:
        earlier = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
        base = counted.select(
            *[F.col(c).alias(f"_g{i}") for i, c in enumerate(within)],
            F.col("_part").alias("_range"),
            (before + 1 - F.col("first")).alias("_base"),
        )
    else:  # one row per range: as many as the write had tasks
        bases, used = [], 0
        for row in sorted(counted.collect(), key=lambda r: r["_part"]):
            bases.append((row["_part"], used + 1 - row["first"]))
            used += row["n"]
        base = spark.createDataFrame(bases, "_range long, _base long")
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(within)]
    numbered = stored.join(base, [*same, part == F.col("_range")])
    return numbered.select((F.col("_seq") + F.col("_base")).alias(name), *df.columns)
