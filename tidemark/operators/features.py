"""Recency, frequency and monetary features and what is derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.scratch import materialize

# Fixed value: a customer counts as churned only after this many days without an order.
CHURN_RECENCY_DAYS = 90

# Different values of one day that a median is read from directly.
MOST_VALUES = 10_000


def rfm_features(
    summary: DataFrame,
    as_of: Column,
    keep: Sequence[str],
    last_order: str = "last_order_date",
    orders: str = "total_orders",
    sales: str = "total_sales",
) -> DataFrame:
    """Days since the last order, number of order lines, sales; customers without order drop out."""
    return summary.where(F.col(last_order).isNotNull()).select(
        *keep,
        F.datediff(as_of, F.col(last_order)).alias("recency_days"),
        F.col(orders).cast("int").alias("frequency"),
        F.col(sales).cast("double").alias("monetary"),
    )


def standardize(
    df: DataFrame, columns: Sequence[str], within: str, suffix: str = "_z"
) -> DataFrame:
    """Add columns with zero mean and unit population deviation per ``within`` day.

    A constant column becomes 0. The statistics have one row per day and are broadcast.
    """
    stats = [F.avg(F.col(c).cast("double")).alias(f"_mean_{c}") for c in columns]
    stats += [F.stddev_pop(F.col(c).cast("double")).alias(f"_dev_{c}") for c in columns]
    joined = df.join(F.broadcast(df.groupBy(within).agg(*stats)), within)
    scaled = [
        (
            (F.col(c) - F.col(f"_mean_{c}"))
            / F.when(F.col(f"_dev_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_dev_{c}"))
        ).alias(c + suffix)
        for c in columns
    ]
    return joined.select(*df.columns, *scaled)


def median_of_days(
    df: DataFrame, column: str, within: str, most: int = MOST_VALUES, cuts: int = 64
) -> DataFrame:
    """``(within, median)``: exact median of a numeric column per ``within`` day, as a double.

    Equal values are counted first. While a day has more than ``most`` different values, approximate
    quantiles cut each day's values into ranges, the ranges' counts tell which of them hold the middle
    ranks, and only those are kept. The last step sees at most ``most`` values of a day, of any number
    type, with fractions or without. NULL values take no part; a day with nothing else is absent.
    """
    day, value = F.col(within).alias("_day"), F.col(column).alias("_value")
    rows = df.where(F.col(column).isNotNull()).select(day, value)
    rows = rows.groupBy("_day", "_value").agg(F.count(F.lit(1)).alias("_n"))
    # Ranks of the one or two middle rows, from 0; after a cut they count from the first row kept.
    rows = materialize(rows, "values")
    total = rows.groupBy("_day").agg(F.sum("_n").alias("_all"))
    wanted = total.select(
        "_day", F.expr("(_all - 1) div 2").alias("_low"), F.expr("_all div 2").alias("_high")
    )
    widest = _most_values(rows)
    while widest > most:
        placed = materialize(_in_ranges(rows, cuts), "ranges")
        counts = placed.groupBy("_day", "_range").agg(F.sum("_n").alias("_n"))
        earlier = Window.partitionBy("_day").orderBy("_range")  # at most ``cuts`` + 1 rows
        counts = counts.withColumn("_before", F.sum("_n").over(earlier) - F.col("_n"))
        middle = _join_days(counts, wanted).where("_before <= _high AND _before + _n > _low")
        middle = materialize(middle, "middle")
        first = middle.groupBy("_day").agg(F.min("_before").alias("_skipped"))
        wanted = _join_days(wanted, first).select(
            "_day", *[(F.col(c) - F.col("_skipped")).alias(c) for c in ("_low", "_high")]
        )
        wanted = materialize(wanted, "ranks")
        kept = middle.select(F.col("_day").alias("_d"), F.col("_range").alias("_r"))
        same = F.col("_day").eqNullSafe(F.col("_d")) & (F.col("_range") == F.col("_r"))
        rows = placed.join(F.broadcast(kept), same, "left_semi").select("_day", "_value", "_n")
        before, widest = widest, _most_values(rows)
        if widest == before:  # only values that agree as doubles are left
            break
    through = F.sum("_n").over(Window.partitionBy("_day").orderBy("_value"))
    ranked = _join_days(rows.withColumn("_through", through), wanted)
    picked = ranked.where("_through > _low AND _through - _n <= _high")
    middle = (F.min("_value").cast("double") + F.max("_value").cast("double")) / 2
    return picked.groupBy(F.col("_day").alias(within)).agg(middle.alias("median"))


def _most_values(rows: DataFrame) -> int:
    return rows.groupBy("_day").count().agg(F.max("count")).first()[0] or 0


def _join_days(df: DataFrame, by_day: DataFrame) -> DataFrame:
    """Add the columns of a table with one row per day."""
    others = [c for c in by_day.columns if c != "_day"]
    named = by_day.select(F.col("_day").alias("_same_day"), *others)
    return df.join(F.broadcast(named), F.col("_day").eqNullSafe(F.col("_same_day"))).drop("_same_day")


def _in_ranges(rows: DataFrame, cuts: int) -> DataFrame:
    """Number the range of each value: how many of its day's cuts lie below it."""
    shares = [i / (cuts + 1) for i in range(1, cuts + 1)]
    bounds = rows.groupBy("_day").agg(F.percentile_approx("_value", shares, F.lit(10 * cuts)).alias("_cuts"))
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col("_value")))
    return _join_days(rows, bounds).withColumn("_range", below).drop("_cuts")


def churn_label(
    df: DataFrame, within: str, recency: str = "recency_days", label: str = "churned"
) -> DataFrame:
    """1 when recency exceeds both the fixed threshold and the day's median, else 0."""
    joined = df.join(F.broadcast(median_of_days(df, recency, within)), within)
    threshold = F.greatest(F.lit(float(CHURN_RECENCY_DAYS)), F.col("median"))
    churned = (F.col(recency) > threshold).cast("int")
    return joined.select(*df.columns, churned.alias(label))
