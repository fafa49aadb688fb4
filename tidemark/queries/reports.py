"""Joins to dimensions, sales summaries, features and model outputs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import features, summaries
from tidemark.operators.latest import latest_per_key_asof
from tidemark.plans import ml, reporting
from tidemark.plans.staging import in_days
from tidemark.queries import query
from tidemark.queries.inputs import (
    ORDER_LINES_SQL,
    ORDERS_AS_OF,
    ORDERS_LAST,
    cents,
    order_lines,
    orders,
    read,
)
from tidemark.scratch import materialize

CUSTOMER_SALES_SQL = f"""
    SELECT l.c_custkey, c_name, n_name, c_mktsegment, COUNT(order_number) AS total_orders,
           CAST(SUM(sales_amount) AS BIGINT) AS total_sales,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
           AVG(sales_amount) AS avg_order_value, MIN(order_date) AS first_order_date,
           MAX(order_date) AS last_order_date,
           date_diff('day', MIN(order_date), MAX(order_date)) AS days_since_first_order
    FROM ({ORDER_LINES_SQL}) l JOIN customer c ON c.c_custkey = l.c_custkey
         LEFT JOIN nation ON n_nationkey = c_nationkey
    GROUP BY l.c_custkey, c_name, n_name, c_mktsegment
"""

# Days on which features are taken; each sees the orders up to then.
FEATURE_DAYS = (dt.date(1996, 12, 31), dt.date(1998, 12, 31), ORDERS_LAST)

RFM_SQL = f"""
    SELECT o_custkey AS customer_key, d AS snapshot_date,
           CAST(date_diff('day', MAX(CAST(o_orderdate AS DATE)), d) AS INTEGER) AS recency_days,
           CAST(COUNT(*) AS INTEGER) AS frequency,
           CAST(SUM(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) AS monetary
    FROM orders, (VALUES {", ".join(f"(DATE '{d}')" for d in FEATURE_DAYS)}) v(d)
    WHERE CAST(o_orderdate AS DATE) <= d GROUP BY o_custkey, d
"""


@query(f"""
    WITH newest AS (
        SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day,
               ROW_NUMBER() OVER (PARTITION BY o_custkey
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '{ORDERS_AS_OF}'
    )
    SELECT c_custkey, c_name, n_name, r_name, o_orderkey AS last_order, day AS last_order_day
    FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey = 1
    LEFT JOIN region ON r_regionkey = n_regionkey
    LEFT JOIN newest ON o_custkey = c_custkey AND rn = 1
""")
def enrich_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers keep their row when a restricted nation or an earlier order is absent."""
    nations = read(spark, sf_dir, "nation").where(F.col("n_regionkey") == 1)
    regions = read(spark, sf_dir, "region")
    log = orders(spark, sf_dir).select("o_custkey", "day", "o_orderkey")
    last = latest_per_key_asof(log, ["o_custkey"], "day", ORDERS_AS_OF, ["o_orderkey"])
    return (
        read(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
        .select(
            "c_custkey",
            "c_name",
            "n_name",
            "r_name",
            F.col("o_orderkey").alias("last_order"),
            F.col("day").alias("last_order_day"),
        )
    )


@query(f"""
    SELECT l.order_number, l.p_partkey, l.sales_amount, l.quantity, l.order_date,
           p.p_partkey AS product_key, c.c_custkey AS customer_key
    FROM ({ORDER_LINES_SQL}) l
    LEFT JOIN part p ON p.p_partkey = l.p_partkey AND p.p_type <> 'PROMO'
    LEFT JOIN customer c ON c.c_custkey = l.c_custkey AND c.c_acctbal >= 0
""")
def fact_with_dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with the keys of two partial dimensions; unmatched lines stay."""
    parts = read(spark, sf_dir, "part").where(F.col("p_type") != "PROMO")
    parts = parts.select(F.col("p_partkey").alias("product_key"))
    people = read(spark, sf_dir, "customer").where(F.col("c_acctbal") >= 0)
    people = people.select(F.col("c_custkey").alias("customer_key"))
    return (
        order_lines(spark, sf_dir)
        .join(parts, F.col("p_partkey") == F.col("product_key"), "left")
        .join(people, F.col("c_custkey") == F.col("customer_key"), "left")
        .select(
            "order_number", "p_partkey", "sales_amount", "quantity", "order_date", "product_key",
            "customer_key",
        )
    )


@query(CUSTOMER_SALES_SQL)
def sales_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    people = read(spark, sf_dir, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    return summaries.customer_summary(
        order_lines(spark, sf_dir), people, ["c_custkey"], ["c_name", "n_name", "c_mktsegment"]
    )


@query(f"""
    WITH products AS (
        SELECT *, CASE WHEN p_type <> 'PROMO' THEN CAST(round(p_retailprice) AS INTEGER)
                       ELSE 0 END AS cost FROM part
    )
    SELECT p.p_partkey, p_name, p_brand, p_type, p_size, cost,
           COUNT(order_number) AS total_orders,
           CAST(SUM(sales_amount) AS BIGINT) AS total_sales,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
           AVG(sales_amount) AS avg_sales_per_order, AVG(sls_price) AS avg_unit_price,
           CAST(SUM(quantity * cost) AS BIGINT) AS total_cost,
           CAST(SUM(sales_amount - quantity * cost) AS BIGINT) AS total_profit,
           MIN(order_date) AS first_sale_date, MAX(order_date) AS last_sale_date
    FROM ({ORDER_LINES_SQL}) l JOIN products p ON p.p_partkey = l.p_partkey
    GROUP BY p.p_partkey, p_name, p_brand, p_type, p_size, cost
""")
def sales_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    cost = F.when(F.col("p_type") != "PROMO", F.round("p_retailprice").cast("int")).otherwise(0)
    products = read(spark, sf_dir, "part").withColumn("cost", cost)
    return summaries.product_summary(
        order_lines(spark, sf_dir),
        products,
        ["p_partkey"],
        ["p_name", "p_brand", "p_type", "p_size", "cost"],
    )


@query(f"""
    SELECT c_name, n_name, total_orders, total_sales FROM ({CUSTOMER_SALES_SQL})
    ORDER BY total_sales DESC, c_custkey LIMIT 10
""")
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = summaries.top_rows(sales_by_customer(spark, sf_dir), "total_sales", ["c_custkey"], 10)
    return ranked.select("c_name", "n_name", "total_orders", "total_sales")


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recency, frequency and monetary value of each customer on each feature day."""
    log = orders(spark, sf_dir).select(
        F.col("o_custkey").alias("customer_key"), "day", cents("o_totalprice").alias("amount")
    )
    # All feature days in one aggregate, so that no order is multiplied before the shuffle.
    totals = []
    for d in FEATURE_DAYS:
        seen = F.col("day") <= F.lit(d)
        totals.append(
            F.struct(
                F.lit(d).alias("snapshot_date"),
                F.max(F.when(seen, F.col("day"))).alias("last_order_date"),
                F.count_if(seen).alias("total_orders"),
                F.sum(F.when(seen, F.col("amount"))).alias("total_sales"),
            )
        )
    per_customer = log.groupBy("customer_key").agg(F.array(*totals).alias("totals"))
    summary = per_customer.select("customer_key", F.inline("totals"))
    return features.rfm_features(summary, F.col("snapshot_date"), ["customer_key", "snapshot_date"])


@query(RFM_SQL)
def rfm_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_features(spark, sf_dir)


@query(f"""
    WITH rfm AS ({RFM_SQL}), s AS (
        SELECT snapshot_date, avg(recency_days) AS mr, stddev_pop(recency_days) AS dr,
               avg(frequency) AS mf, stddev_pop(frequency) AS df, avg(monetary) AS mm,
               stddev_pop(monetary) AS dm
        FROM rfm GROUP BY 1
    )
    SELECT customer_key, snapshot_date, round((recency_days - mr) / dr, 6) AS recency_days_z,
           round((frequency - mf) / df, 6) AS frequency_z, round((monetary - mm) / dm, 6) AS monetary_z
    FROM rfm JOIN s USING (snapshot_date)
""")
def standardize_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = features.standardize(customer_features(spark, sf_dir), ml.FEATURES, "snapshot_date")
    rounded = [F.round(f"{c}_z", 6).alias(f"{c}_z") for c in ml.FEATURES]
    return scaled.select("customer_key", "snapshot_date", *rounded)


@query(f"""
    WITH rfm AS ({RFM_SQL}), m AS (
        SELECT snapshot_date, median(recency_days) AS middle FROM rfm GROUP BY 1
    )
    SELECT customer_key, snapshot_date, recency_days,
           CAST(recency_days > greatest(90, middle) AS INTEGER) AS churned
    FROM rfm JOIN m USING (snapshot_date)
""")
def churn_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = features.churn_label(customer_features(spark, sf_dir), "snapshot_date")
    return labelled.select("customer_key", "snapshot_date", "recency_days", "churned")


@query(f"""
    WITH rfm AS ({RFM_SQL}), scored AS (
        SELECT r.*, c_name AS first_name, c_mktsegment AS last_name, n_name AS country,
               recency_days / (recency_days + 90) AS churn_probability,
               CASE WHEN frequency > 12 THEN 'Champion' WHEN frequency > 9 THEN 'Loyal'
                    ELSE 'At Risk' END AS segment_label
        FROM rfm r JOIN customer ON c_custkey = customer_key
                   JOIN nation ON n_nationkey = c_nationkey
    )
    SELECT first_name, last_name, country, segment_label, round(churn_probability, 3) AS churn_prob,
           recency_days, frequency, round(monetary, 0) AS monetary
    FROM scored WHERE churn_probability >= 0.5 AND snapshot_date = DATE '{ORDERS_LAST}'
    ORDER BY churn_probability DESC, customer_key LIMIT 15
""")
def high_risk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report over closed-form stand-ins for the two models' outputs."""
    rfm = materialize(customer_features(spark, sf_dir), "rfm")
    people = read(spark, sf_dir, "customer").join(
        read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    people = people.select(
        F.col("c_custkey").alias("customer_key"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("n_name").alias("country"),
    )
    score = F.col("recency_days") / (F.col("recency_days") + 90)
    churn = rfm.withColumn("churn_probability", score)
    churn = churn.withColumn("is_high_risk", F.col("churn_probability") >= ml.HIGH_RISK)
    label = F.when(F.col("frequency") > 12, "Champion").when(F.col("frequency") > 9, "Loyal")
    segments = rfm.withColumn("segment_label", label.otherwise("At Risk"))
    named = rfm.join(people, "customer_key")
    return reporting.high_risk_customers(churn, segments, named, ORDERS_LAST)


def last_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of the newest day as a stored table; models are fitted per day."""
    return in_days(materialize(customer_features(spark, sf_dir), "rfm"), ORDERS_LAST, ORDERS_LAST)


# Group 0 to 3 of a customer, from the weakest; the ranges of the groups lie far apart in every feature.
GROUP = "c_custkey % 4"


@query(f"""
    SELECT c_custkey AS customer_key, CAST(1000 - 300 * ({GROUP}) + c_custkey % 7 AS INTEGER) AS recency_days,
           CAST(1 + 40 * ({GROUP}) + c_nationkey % 5 AS INTEGER) AS frequency,
           CAST(100000 * ({GROUP}) + c_acctbal AS DOUBLE) AS monetary,
           CASE {GROUP} WHEN 0 THEN 0 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 3 END AS segment_id,
           CASE {GROUP} WHEN 0 THEN 'At Risk' WHEN 1 THEN 'Promising' WHEN 2 THEN 'Loyal' ELSE 'Champion' END
               AS segment_label
    FROM customer
""")
def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, their features moved apart by group so that one clustering is best."""
    group = F.expr(GROUP)
    moved = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_key"),
        (1000 - 300 * group + F.col("c_custkey") % 7).cast("int").alias("recency_days"),
        (1 + 40 * group + F.col("c_nationkey") % 5).cast("int").alias("frequency"),
        (100000 * group + F.col("c_acctbal")).cast("double").alias("monetary"),
    )
    return ml.customer_segments(moved, ["customer_key"])


def newton_sql(points: str, weights: Sequence[str], steps: int) -> str:
    """CTEs that minimise sum(log loss) + |w|^2 / 2 over ``points`` (``x1`` .., ``y``); the last is ``w<steps>``.

    ``x0`` is 1 and its weight is left out of the penalty. Each step solves its linear system by elimination.
    """
    n = len(weights)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    parts = [f"w0_ AS (SELECT {', '.join(f'CAST(0 AS DOUBLE) AS {w}' for w in weights)})"]
    for step in range(steps):
        margin = " + ".join(f"{w} * x{i}" for i, w in enumerate(weights))
        sums = [
            f"sum(p * (1 - p) * x{i} * x{j}) + {int(i == j and i > 0)} AS h{i}{j}" for i, j in pairs
        ] + [f"sum((p - y) * x{i})" + (f" + any_value({w})" if i else "") + f" AS g{i}" for i, w in enumerate(weights)]
        kept = ", ".join(f"any_value({w}) AS {w}" for w in weights)
        inner = f"SELECT *, 1 / (1 + exp(-({margin}))) AS p FROM {points}, w{step}_"
        solved = f"SELECT {', '.join(sums)}, {kept} FROM ({inner})"
        for k in range(n):
            reduced = [
                f"h{i}{j} - h{k}{i} * h{k}{j} / h{k}{k} AS h{i}{j}" for i, j in pairs if i > k
            ] + [f"g{i} - h{k}{i} * g{k} / h{k}{k} AS g{i}" for i in range(k + 1, n)]
            same = [f"h{i}{j}" for i, j in pairs if i <= k] + [f"g{i}" for i in range(k + 1)] + list(weights)
            solved = f"SELECT {', '.join(reduced + same)} FROM ({solved})"
        for k in reversed(range(n)):
            later = "".join(f" - h{k}{j} * d{j}" for j in range(k + 1, n))
            solved = f"SELECT *, (g{k}{later}) / h{k}{k} AS d{k} FROM ({solved})"
        moved = ", ".join(f"{w} - d{i} AS {w}" for i, w in enumerate(weights))
        parts.append(f"w{step + 1}_ AS MATERIALIZED (SELECT {moved} FROM ({solved}))")
    return ", ".join(parts)


@query(f"""
    WITH rfm AS ({RFM_SQL}), newest AS (SELECT * FROM rfm WHERE snapshot_date = DATE '{ORDERS_LAST}'), s AS (
        SELECT avg(recency_days) AS mr, stddev_pop(recency_days) AS dr, avg(frequency) AS mf,
               stddev_pop(frequency) AS df, avg(monetary) AS mm, stddev_pop(monetary) AS dm,
               greatest(90, median(recency_days)) AS threshold
        FROM newest
    ), points AS MATERIALIZED (
        SELECT customer_key, recency_days, frequency, monetary, 1 AS x0, (recency_days - mr) / dr AS x1,
               (frequency - mf) / df AS x2, (monetary - mm) / dm AS x3,
               CAST(recency_days > threshold AS INTEGER) AS y
        FROM newest, s
    ), {newton_sql("points", ["b", "r", "f", "m"], 25)}
    SELECT customer_key, recency_days, frequency, monetary,
           round(1 / (1 + exp(-(b + r * x1 + f * x2 + m * x3))), 3) AS churn_probability,
           1 / (1 + exp(-(b + r * x1 + f * x2 + m * x3))) >= 0.5 AS is_high_risk
    FROM points, w25_
""")
def churn_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    predictions, _ = ml.churn_predictions(last_features(spark, sf_dir), ["customer_key"])
    return predictions.withColumn("churn_probability", F.round("churn_probability", 3))
