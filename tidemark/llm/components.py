"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import materialize


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node in ``links`` (``a``, ``b``).

    Each round every node joins the neighbour that a hash puts first, if that is before itself;
    then joined nodes become one and links within it go. A constant share of the nodes goes each
    round, so rounds grow with the logarithm of their number. Every round's tables are written;
    the driver sees one count a round. Minima are combined before the shuffle, so a node with
    very many links costs one row a task.
    """
    first = F.xxhash64(F.lit(5), "v")
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialize(links.where("a < b").distinct(), "links")
    labels = None
    while labels is None or not links.isEmpty():
        both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            links.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        near = both.groupBy("u").agg(F.min_by("v", first).alias("v"), F.min(first).alias("rank"))
        joins = F.col("rank") < F.xxhash64(F.lit(5), "u")
        moved = near.where(joins).select("u", F.col("v").alias("into"))
        if labels is None:
            labels = near.select(F.col("u").alias("node"), F.when(joins, F.col("v")).otherwise(F.col("u")).alias("root"))
            moved = materialize(moved, "moved")
        else:
            moved = materialize(moved, "moved")
            labels = labels.join(moved, labels["root"] == moved["u"], "left")
            labels = labels.select("node", F.coalesce("into", "root").alias("root"))
        labels = materialize(labels, "labels")
        ends = links.join(moved, links["a"] == moved["u"], "left").select(F.coalesce("into", "a").alias("a"), "b")
        ends = ends.join(moved, ends["b"] == moved["u"], "left").select("a", F.coalesce("into", "b").alias("b"))
        ends = ends.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        links = materialize(ends.distinct(), "links")
    least = labels.groupBy("root").agg(F.min("node").alias("component"))
    return labels.join(least, "root").select("node", "component")
