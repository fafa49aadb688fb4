"""The benchmark tables in the shape the operators expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Days on which queries look back, and the days features are taken on; not bounds of the tables.
EVENTS_FIRST, EVENTS_LAST = dt.date(2024, 1, 1), dt.date(2024, 1, 30)
EVENTS_AS_OF = dt.date(2024, 1, 15)
ORDERS_FIRST, ORDERS_LAST = dt.date(1995, 1, 1), dt.date(2001, 8, 1)
ORDERS_AS_OF = dt.date(1998, 6, 30)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cents(column: str) -> Column:
    """Money as whole cents: sums are then exact in any order."""
    return whole(F.col(column) * 100)


def whole(value: Column) -> Column:
    """Nearest whole number of a value that is not negative; cheaper than a decimal rounding."""
    return F.floor(value + 0.5).cast("bigint")


def day_number(day: str) -> Column:
    """Date as a ``yyyyMMdd`` number."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change log of users, with its day."""
    return read(spark, sf_dir, "events").select(
        "user_id", "ts", "event_id", "event_type", "value", F.to_date("ts").alias("day")
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))


def span(days: DataFrame, day: str = "day") -> tuple[dt.date, dt.date]:
    """First and last day in a frame; queries over a whole period take its bounds from the rows."""
    first, last = days.agg(F.min(day), F.max(day)).first()
    return first or ORDERS_AS_OF, last or ORDERS_AS_OF


def order_span(spark: SparkSession, sf_dir: str) -> tuple[dt.date, dt.date]:
    return span(orders(spark, sf_dir))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with customer and order day."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_partkey").alias("p_partkey"),
        cents("l_extendedprice").alias("sales_amount"),
        F.col("l_quantity").cast("int").alias("quantity"),
        whole(F.col("l_extendedprice") * 100 / F.col("l_quantity")).alias("sls_price"),
    )
    heads = orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_custkey").alias("c_custkey"),
        F.col("day").alias("order_date"),
    )
    joined = lines.join(heads, "l_orderkey")
    return joined.withColumnRenamed("l_orderkey", "order_number")


ORDER_LINES_SQL = """
    SELECT l_orderkey AS order_number, l_partkey AS p_partkey, o_custkey AS c_custkey,
           CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS sales_amount,
           CAST(l_quantity AS INTEGER) AS quantity,
           CAST(floor(l_extendedprice * 100 / l_quantity + 0.5) AS BIGINT) AS sls_price,
           CAST(o_orderdate AS DATE) AS order_date
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
"""
