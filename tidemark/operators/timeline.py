"""Change logs, version histories and slow snapshots on a daily grid."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key, latest_per_key_asof

ONE_DAY = dt.timedelta(days=1)


def each_day(start: dt.date, end: dt.date) -> Column:
    """Explodes a row into one copy per day of ``[start, end]``."""
    return F.explode(F.sequence(F.lit(start), F.lit(end)))


def stamp_days(df: DataFrame, day: str, start: dt.date, end: dt.date) -> DataFrame:
    """Static table on the daily grid: every day of the range holds its own copy."""
    return df.withColumn(day, each_day(start, end))


def daily_state(
    log: DataFrame,
    keys: Sequence[str],
    day: str,
    start: dt.date,
    end: dt.date,
    newest: Sequence[str] = (),
    state_day: str = "snapshot_date",
) -> DataFrame:
    """Full state of a change log on every day of ``[start, end]``, in one job.

    Changes before the range collapse onto its first day and several changes of one day
    into the newest, both by a map-side aggregate. What reaches the window is therefore at
    most one row per key and day, however often a key changes. The window gives each change
    the days until the next one.
    """
    if start == end:
        state = latest_per_key_asof(log, keys, day, start, newest)
        return state.withColumn(state_day, F.lit(start))
    opened = log.where(F.col(day) <= F.lit(end)).withColumn(
        "_from", F.greatest(F.col(day), F.lit(start))
    )
    changes = latest_per_key(opened, [*keys, "_from"], [day, *[c for c in newest if c != day]])
    following = F.lead("_from").over(Window.partitionBy(*keys).orderBy("_from"))
    spans = changes.withColumn("_to", F.coalesce(F.date_sub(following, 1), F.lit(end)))
    days = spans.withColumn("_on", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to")
    return days.withColumn(state_day, F.col("_on")).drop("_on")


def state_from_previous(
    previous: DataFrame, changes: DataFrame, day: str, start: dt.date, end: dt.date, state_day: str = "snapshot_date"
) -> DataFrame:
    """A change log for ``[start, end]`` that holds the state of the day before instead of older changes.

    ``previous`` is a table of daily states, of which only the day before ``start`` is read;
    ``changes`` is the log, of which only ``[start, end]`` is. Given to ``daily_state``, it makes
    the same states as the whole log does.
    """
    before = previous.where(F.col(state_day) == F.lit(start - ONE_DAY)).drop(state_day)
    if start == end:
        fresh = changes.where(F.col(day) == F.lit(start))
    else:
        fresh = changes.where(F.col(day).between(F.lit(start), F.lit(end)))
    return before.unionByName(fresh.select(*before.columns))


def scd2_close_out(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    tiebreak: Sequence[str],
    end: str = "end_date",
    current: str | None = "is_current",
) -> DataFrame:
    """Close each version one day before the next version of its key starts.

    Versions of a key are ordered by ``start`` and then ``tiebreak``, which together must
    tell them apart. The next start is looked up on one row per key and start day, so the
    window never holds more rows of a key than there are days, and the full table only
    takes part in an equi-join that can be split when one key is hot.
    """
    rank = F.struct(*[F.col(c) for c in tiebreak])
    starts = df.groupBy(*keys, start).agg(F.max(rank).alias("_last"))
    by_key = Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_last())
    starts = starts.withColumn("_next", F.lead(start).over(by_key))
    named = starts.select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*keys, start])], "_last", "_next"
    )
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*keys, start])]
    joined = df.join(named, same, "left")
    follower = F.when(rank < F.col("_last"), F.col(start)).otherwise(F.col("_next"))
    closed = joined.withColumn(end, F.date_sub(follower.cast("date"), 1))
    if current:
        closed = closed.withColumn(current, F.col(end).isNull())
    return closed.select(*[c for c in df.columns if c not in (end, current)], end, *([current] if current else []))


def partition_days(df: DataFrame, day: str) -> list[dt.date]:
    """Distinct partition dates, ascending. One entry per calendar day at most."""
    rows = df.select(F.col(day).cast("date").alias("day")).distinct().collect()
    return sorted(r.day for r in rows if r.day is not None)


def effective_days(
    spark: SparkSession, snapshots: Sequence[dt.date], start: dt.date, end: dt.date
) -> DataFrame:
    """``(day, snapshot)`` for the days of ``[start, end]`` covered by a snapshot.

    Each day maps to the newest snapshot on or before it; days before the first snapshot
    are absent.
    """
    ordered = sorted(set(snapshots))
    untils = [s - ONE_DAY for s in ordered[1:]] + [end]
    spans = [(s, max(s, start), min(u, end)) for s, u in zip(ordered, untils)]
    spans = [s for s in spans if s[1] <= s[2]]
    frame = spark.createDataFrame(spans, "snapshot date, first date, last date")
    return frame.select(F.explode(F.sequence("first", "last")).alias("day"), "snapshot")


def reachable_snapshots(
    slow: DataFrame, snapshot: str, known: Sequence[dt.date], start: dt.date, end: dt.date
) -> DataFrame:
    """Snapshots that can be in effect in ``[start, end]``; literals, so they prune the scan."""
    first = max([s for s in known if s <= start], default=start)
    return slow.where(F.col(snapshot).between(F.lit(first), F.lit(end)))


def bridge_to_days(
    slow: DataFrame,
    snapshot: str,
    day: str,
    start: dt.date,
    end: dt.date,
    known: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Slow-cadence snapshots on the daily grid: each day holds the snapshot in effect.

    ``known`` lists the snapshot dates where the caller has them already. The broadcast side
    has one row per day of the range.
    """
    dates = partition_days(slow, snapshot) if known is None else known
    dates = [s for s in dates if s <= end]
    mapping = effective_days(slow.sparkSession, dates, start, end).select(
        F.col("snapshot").alias("_snapshot"), F.col("day").alias("_day")
    )
    reachable = reachable_snapshots(slow, snapshot, dates, start, end)
    joined = reachable.join(F.broadcast(mapping), F.col(snapshot) == F.col("_snapshot"))
    return joined.withColumn(day, F.col("_day")).drop("_snapshot", "_day")
