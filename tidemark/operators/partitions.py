"""Which partitions exist, which are missing, which can be built, which are late.

All operators work on inventories: ``(table_name, day)`` with one row per stored partition. An
inventory has at most one row per table and calendar day, whatever the size of the tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def partition_inventory(tables: Mapping[str, DataFrame], day: str = "snapshot_date") -> DataFrame:
    """Distinct partitions of each table."""
    return _union(
        [
            df.select(F.lit(name).alias("table_name"), F.col(day).alias("day")).distinct()
            for name, df in tables.items()
        ]
    )


def partition_row_counts(tables: Mapping[str, DataFrame], day: str = "snapshot_date") -> DataFrame:
    """Rows per table and partition, ordered by both."""
    counts = [
        df.groupBy(F.lit(name).alias("table_name"), F.col(day).alias("day")).agg(
            F.count(F.lit(1)).alias("row_count")
        )
        for name, df in tables.items()
    ]
    return _union(counts).orderBy("table_name", "day")


def date_spine(df: DataFrame, day: str, until: Column | None = None) -> DataFrame:
    """Every calendar day from the first day in ``df`` to ``until`` (default: the last)."""
    bounds = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    last = F.col("last") if until is None else until
    bounds = bounds.select("first", last.alias("last")).where(F.col("first") <= F.col("last"))
    return bounds.select(F.explode(F.sequence("first", "last")).alias("day"))


def recent_partitions(inventory: DataFrame, n: int, day: str = "day") -> DataFrame:
    """The ``n`` newest distinct partitions."""
    return inventory.select(day).distinct().orderBy(F.col(day).desc()).limit(n)


def missing_partitions(inventory: DataFrame, as_of: dt.date, lookback: int) -> DataFrame:
    """Days of the lookback window ending on ``as_of`` that a known table lacks."""
    first = as_of - dt.timedelta(days=lookback - 1)
    wanted = (
        inventory.select("table_name")
        .distinct()
        .withColumn("day", F.explode(F.sequence(F.lit(first), F.lit(as_of))))
    )
    present = inventory.where(F.col("day").between(F.lit(first), F.lit(as_of)))
    return wanted.join(present, ["table_name", "day"], "left_anti")


def unbuilt_partitions(candidates: DataFrame, built: DataFrame, day: str = "day") -> DataFrame:
    """Candidate days that the target does not hold yet."""
    return candidates.select(day).distinct().join(built.select(day).distinct(), day, "left_anti")


def partition_readiness(
    exact: DataFrame,
    exact_names: Sequence[str],
    slow: DataFrame,
    slow_names: Sequence[str] = (),
) -> DataFrame:
    """Days on which a target can be built.

    Every exact input must hold that very day, and every slow input must hold some
    partition on or before it. Both arguments are inventories; the names say which inputs
    are required, so an input without any partition blocks all days.
    """
    ready = (
        exact.where(F.col("table_name").isin(*exact_names))
        .distinct()
        .groupBy("day")
        .agg(F.count(F.lit(1)).alias("inputs"))
        .where(F.col("inputs") == len(set(exact_names)))
        .select("day")
    )
    if not slow_names:
        return ready
    starts = (
        slow.where(F.col("table_name").isin(*slow_names)).groupBy("table_name").agg(F.min("day").alias("day"))
    )
    covered_from = starts.agg(
        F.when(F.count(F.lit(1)) == len(set(slow_names)), F.max("day")).alias("day")
    )
    return ready.where(F.col("day") >= covered_from.scalar())


def days_of_any(inventory: DataFrame, names: Sequence[str]) -> DataFrame:
    """Days held by at least one of the named tables."""
    return inventory.where(F.col("table_name").isin(*names)).select("day").distinct()


def due_partitions(candidates: DataFrame, built: DataFrame, recent: int) -> DataFrame:
    """Of the newest ``recent`` candidate days, those that the target does not hold yet."""
    return unbuilt_partitions(recent_partitions(candidates, recent), built)


@dataclass(frozen=True)
class Freshness:
    """Newest data must not be older than ``hours`` before the last deadline.

    The deadline is ``deadline_hour`` o'clock every day, or on ``month_day`` of every month.
    """

    deadline_hour: int
    hours: int
    month_day: int | None = None

    def last_deadline(self, now: dt.datetime) -> dt.datetime:
        """The newest deadline that is not after ``now``."""
        today = dt.datetime.combine(now.date(), dt.time(self.deadline_hour))
        if self.month_day is None:
            return today if today <= now else today - dt.timedelta(days=1)
        this_month = today.replace(day=self.month_day)
        if this_month <= now:
            return this_month
        return (today.replace(day=1) - dt.timedelta(days=1)).replace(day=self.month_day)

    def oldest_allowed(self, now: dt.datetime) -> dt.datetime:
        return self.last_deadline(now) - dt.timedelta(hours=self.hours)


# Deadlines by layer.
LANDING_DAILY = Freshness(deadline_hour=9, hours=24)
LANDING_MONTHLY = Freshness(deadline_hour=9, hours=28 * 24, month_day=2)
MODELS = Freshness(deadline_hour=10, hours=24)
ML = Freshness(deadline_hour=11, hours=24)


def freshness_audit(
    tables: Mapping[str, tuple[DataFrame, str, Freshness]], now: dt.datetime
) -> DataFrame:
    """Newest timestamp of each table against the oldest one its deadline allows."""
    checks = []
    for name, (df, stamp, rule) in tables.items():
        # By way of text, so that the session's time zone plays no part.
        limit = F.lit(rule.oldest_allowed(now).isoformat(sep=" ")).cast("timestamp_ntz")
        newest = df.agg(F.max(F.col(stamp).cast("timestamp_ntz")).alias("newest"))
        checks.append(
            newest.select(
                F.lit(name).alias("table_name"),
                "newest",
                limit.alias("oldest_allowed"),
                F.when(F.col("newest") >= limit, "PASS").otherwise("FAIL").alias("status"),
            )
        )
    return _union(checks)


def freshness_of_loads(loads: DataFrame, rules: Mapping[str, Freshness], now: dt.datetime) -> DataFrame:
    """Like ``freshness_audit``, from the times at which partitions were published.

    ``loads`` has ``table_name`` and ``published_at``, as a warehouse's statistics do; no data file is
    opened. A table that nothing was ever published to fails.
    """
    limits = [(name, rule.oldest_allowed(now).isoformat(sep=" ")) for name, rule in rules.items()]
    asked = loads.sparkSession.createDataFrame(limits, "table_name string, oldest_allowed string")
    asked = asked.withColumn("oldest_allowed", F.col("oldest_allowed").cast("timestamp_ntz"))
    newest = loads.groupBy("table_name").agg(F.max(F.col("published_at").cast("timestamp_ntz")).alias("newest"))
    status = F.when(F.col("newest") >= F.col("oldest_allowed"), "PASS").otherwise("FAIL").alias("status")
    return asked.join(newest, "table_name", "left").select("table_name", "newest", "oldest_allowed", status)
