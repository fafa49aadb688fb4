"""Partitions whose inputs have changed since they were built.

``versions`` (``table_name, day, version``) has the newest version of every partition, ``built``
(``table_name, day, inputs``) the versions of its inputs that each built partition saw, and
``reads`` says for each table how it finds the partitions of its inputs: of the same day, the newest on or
before it, the whole history up to it, or a table without partitions. All of it is about partitions: one
row per table and day, never one per row of a table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialize
from tidemark.sinks.versions import HISTORY, NEWEST, SAME_DAY, STATIC

Reads = Mapping[str, Mapping[str, str]]


def partition_inputs(built: DataFrame, versions: DataFrame, reads: Reads) -> DataFrame:
    """Each built partition beside each of its inputs, as it was and as it is now.

    ``table_name, day, input_name, kind, used, current, input_day``: ``current`` is the version that a
    build would see today, NULL if none, ``input_day`` its newest partition.
    """
    rows = [(t, i, kind) for t, inputs in reads.items() for i, kind in inputs.items()]
    declared = built.sparkSession.createDataFrame(rows, "table_name string, input_name string, kind string")
    asked = built.join(declared, "table_name").select(
        "table_name", "day", "input_name", "kind", F.try_element_at("inputs", F.col("input_name")).alias("used")
    )
    known = versions.select(F.col("table_name").alias("input_name"), F.col("day").alias("input_day"), "version")
    dated, static = known.where("input_day IS NOT NULL"), known.where("input_day IS NULL").drop("input_day")
    # The days that are asked about take their places among the input's own; each of its
    # partitions is one row, so the window never sees more than two rows per day and input.
    days = asked.where(F.col("kind") != STATIC).select("input_name", "day").distinct()
    places = days.join(dated.withColumnRenamed("input_day", "day"), ["input_name", "day"], "full")
    up_to = Window.partitionBy("input_name").orderBy("day")
    own_day = F.when(F.col("version").isNotNull(), F.col("day"))
    seen = places.select(
        "input_name",
        "day",
        F.col("version").alias("same_day"),
        F.last("version", True).over(up_to).alias("newest"),
        F.max("version").over(up_to).alias("history"),
        F.last(own_day, True).over(up_to).alias("input_day"),
    )
    fixed = static.groupBy("input_name").agg(F.max("version").alias("fixed"))
    current = (
        F.when(F.col("kind") == SAME_DAY, F.col("same_day"))
        .when(F.col("kind") == NEWEST, F.col("newest"))
        .when(F.col("kind") == HISTORY, F.col("history"))
        .otherwise(F.col("fixed"))
    )
    joined = asked.join(seen, ["input_name", "day"], "left").join(fixed, "input_name", "left")
    return joined.select("table_name", "day", "input_name", "kind", "used", current.alias("current"), "input_day")


def levels(reads: Reads) -> int:
    """How many tables a change passes through at most."""
    depth: dict[str, int] = {}

    def of(name: str) -> int:
        if name not in depth:
            depth[name] = 1 + max((of(i) for i in reads[name]), default=0) if name in reads else 0
        return depth[name]

    return max((of(name) for name in reads), default=0)


def stale_partitions(built: DataFrame, versions: DataFrame, reads: Reads) -> DataFrame:
    """``table_name, day, changed``: built partitions that a build would make from other inputs now.

    ``changed`` tells whether an input itself has another version; else it is stale only because
    what it reads is stale. One round per level of tables, each over the partitions' rows.
    """
    inputs = materialize(partition_inputs(built, versions, reads), "partition-inputs")
    changed = inputs.where(~F.col("used").eqNullSafe(F.col("current"))).select("table_name", "day").distinct()
    stale = materialize(changed.withColumn("changed", F.lit(True)), "stale")
    for _ in range(levels(reads) - 1):
        own = stale.select(F.col("table_name").alias("input_name"), F.col("day").alias("input_day")).distinct()
        at = F.when(F.col("kind") == NEWEST, F.col("input_day")).otherwise(F.col("day"))
        by_day = inputs.where(F.col("kind").isin(SAME_DAY, NEWEST)).withColumn("input_day", at)
        by_day = by_day.join(own, ["input_name", "input_day"], "left_semi")
        first = own.groupBy("input_name").agg(F.min("input_day").alias("first"))
        by_history = inputs.where(F.col("kind") == HISTORY).join(first, "input_name").where(F.col("first") <= F.col("day"))
        more = by_day.select("table_name", "day").unionByName(by_history.select("table_name", "day"))
        more = more.withColumn("changed", F.lit(False)).unionByName(stale)
        stale = materialize(more.groupBy("table_name", "day").agg(F.max("changed").alias("changed")), "stale")
    return stale
