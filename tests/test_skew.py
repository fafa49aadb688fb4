"""A third of all rows in one key, and another third without a key."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import plan_of
from tidemark.operators import latest, summaries, timeline
from tidemark.plans import marts

D1 = dt.date(2026, 4, 1)
ROWS = 60_000


@pytest.fixture(scope="module")
def lines(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 3 == 1, (F.col("id") % 5000).cast("int"))
    return spark.range(ROWS, numPartitions=8).select(
        F.col("id").cast("string").alias("sls_ord_num"),
        F.concat(F.lit("P"), (F.col("id") % 40).cast("string")).alias("sls_prd_key"),
        key.alias("sls_cust_id"),
        F.date_add(F.lit(D1), (F.col("id") % 9).cast("int")).alias("sls_order_dt"),
        F.lit(None).cast("date").alias("sls_ship_dt"),
        F.lit(None).cast("date").alias("sls_due_dt"),
        (F.col("id") % 100).cast("int").alias("sls_sales"),
        F.lit(1).alias("sls_quantity"),
        F.lit(1.0).alias("sls_price"),
        F.lit(D1).alias("snapshot_date"),
    )


@pytest.fixture
def small_partitions(spark):
    """Make a few kilobytes count as a large partition, and no table as small."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed_plan(df):
    """The final plan, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_and_missing_customers_are_split_in_the_fact_join(spark, lines, small_partitions):
    customers = spark.range(5000).select(
        (F.col("id") + 1).alias("customer_key"), F.col("id").cast("int").alias("customer_id"),
        F.lit(D1).alias("snapshot_date"),
    )
    products = spark.range(30).select(
        (F.col("id") + 1).alias("product_key"),
        F.concat(F.lit("P"), F.col("id").cast("string")).alias("product_number"),
        F.lit(D1).alias("snapshot_date"),
    )
    fact = marts.fct_sales(lines, products, customers, D1, D1)
    assert "skew=true" in executed_plan(fact)
    counts = fact.agg(F.count("*"), F.count("customer_key"), F.count("product_key")).first()
    assert tuple(counts) == (ROWS, ROWS * 2 // 3, ROWS * 3 // 4)


def test_hot_key_is_split_in_the_close_out(lines, small_partitions):
    log = lines.select("sls_cust_id", "sls_order_dt", F.col("sls_ord_num").cast("int").alias("id"))
    closed = timeline.scd2_close_out(log, ["sls_cust_id"], "sls_order_dt", ["id"])
    plain = log.withColumn(
        "end_date",
        F.date_sub(F.lead("sls_order_dt").over(Window.partitionBy("sls_cust_id").orderBy("sls_order_dt", "id")), 1),
    ).withColumn("is_current", F.col("end_date").isNull())
    assert closed.exceptAll(plain).isEmpty() and plain.exceptAll(closed).isEmpty()


def test_aggregates_combine_before_the_shuffle(lines):
    newest = plan_of(latest.latest_per_key(lines, ["sls_cust_id"], ["sls_order_dt"]))
    exchange = newest.index("Exchange")
    assert "partial_max" in newest[exchange:]
    fact = lines.select(
        F.col("sls_cust_id").alias("customer_key"), F.col("sls_ord_num").alias("order_number"),
        F.col("sls_sales").alias("sales_amount"), F.col("sls_quantity").alias("quantity"),
        F.col("sls_order_dt").alias("order_date"),
    )
    people = fact.select("customer_key").distinct().withColumn("name", F.lit("x"))
    summary = summaries.customer_summary(fact, people, ["customer_key"], ["name"])
    assert summary.agg(F.sum("total_orders")).first()[0] == ROWS * 2 // 3
    plan = plan_of(summary)
    assert plan.count("Exchange hashpartitioning(customer_key") <= 3


def test_daily_state_of_a_hot_key(lines):
    log = lines.select("sls_cust_id", "sls_order_dt", F.col("sls_ord_num").cast("int").alias("id"))
    end = D1 + dt.timedelta(days=10)
    state = timeline.daily_state(log, ["sls_cust_id"], "sls_order_dt", D1, end, ["id"])
    per_day = {r.snapshot_date: r["count"] for r in state.groupBy("snapshot_date").count().collect()}
    keys = log.select("sls_cust_id").distinct().count()
    assert per_day[end] == keys and per_day[D1] <= keys
    hot = state.where("sls_cust_id = 7").orderBy("snapshot_date").collect()
    assert len(hot) == 11 and hot[-1].sls_order_dt == max(h.sls_order_dt for h in hot)
