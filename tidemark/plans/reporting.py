"""Summary reports and customer features for the days ``start..end``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.features import rfm_features
from tidemark.operators.summaries import customer_summary, product_summary, top_rows
from tidemark.plans.staging import SNAPSHOT, in_days, with_load_time


def sales_summary_by_customer(
    fact: DataFrame, customers: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    return customer_summary(
        in_days(fact, start, end),
        in_days(customers, start, end),
        on=["customer_key", SNAPSHOT],
        attributes=["customer_id", "first_name", "last_name", "country", "gender", "marital_status"],
    )


def sales_performance_by_product(
    fact: DataFrame, products: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    return product_summary(
        in_days(fact, start, end),
        in_days(products, start, end),
        on=["product_key", SNAPSHOT],
        attributes=[
            "product_id", "product_number", "product_name", "product_line", "category",
            "subcategory", "cost",
        ],
    )


def customer_rfm(summary: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    features = rfm_features(
        in_days(summary, start, end),
        F.col(SNAPSHOT),
        keep=["customer_key", "customer_id", "first_name", "last_name", "country", SNAPSHOT],
    )
    return with_load_time(features.withColumn("features_as_of_date", F.col(SNAPSHOT)))


def top_customers(summary: DataFrame, n: int = 10) -> DataFrame:
    """Customers with the greatest sales; of equal sales the lower key comes first."""
    columns = ["first_name", "last_name", "country", "total_orders", "total_sales"]
    ranked = top_rows(summary, "total_sales", ["customer_key", SNAPSHOT], n)
    return ranked.select(*columns)


def high_risk_customers(
    churn: DataFrame, segments: DataFrame, rfm: DataFrame, day: dt.date, n: int = 15
) -> DataFrame:
    """High-risk customers of a day with their segment and name, most likely churners first."""
    on = ["customer_key", SNAPSHOT]
    risky = in_days(churn, day, day).where("is_high_risk")
    named = risky.join(in_days(segments, day, day).select(*on, "segment_label"), on).join(
        in_days(rfm, day, day).select(*on, "first_name", "last_name", "country"), on
    )
    ranked = top_rows(named, "churn_probability", ["customer_key"], n)
    return ranked.select(
        "first_name",
        "last_name",
        "country",
        "segment_label",
        F.round("churn_probability", 3).alias("churn_prob"),
        "recency_days",
        "frequency",
        F.round("monetary", 0).alias("monetary"),
    )
