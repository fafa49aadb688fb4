"""Dimensions and facts for the days ``start..end``.

Surrogate keys are numbered inside each day, so they only join to rows of the same day.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleansing import first_known
from tidemark.operators.keys import surrogate_key
from tidemark.operators.latest import current_versions
from tidemark.operators.timeline import bridge_to_days, daily_state
from tidemark.plans.staging import SNAPSHOT, in_days, with_load_time


PERSON = ["cst_id", "cst_key", "cst_firstname", "cst_lastname", "cst_marital_status", "cst_gndr", "cst_create_date"]


def customer_changes(customers: DataFrame) -> DataFrame:
    """Staged customers as a change log."""
    return customers.select(*PERSON, F.col(SNAPSHOT).alias("changed_on"))


def location_changes(locations: DataFrame) -> DataFrame:
    """Staged locations as a change log."""
    return locations.select("CID", "CNTRY", F.col(SNAPSHOT).alias("changed_on"))


def customer_state(changes: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Newest record of each customer on each day."""
    return daily_state(changes, ["cst_id"], "changed_on", start, end)


def location_state(changes: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Newest location of each customer on each day."""
    return daily_state(changes, ["CID"], "changed_on", start, end)


def dim_customers(
    customers: DataFrame, reference: DataFrame, locations: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Customer state of each day: newest record and newest location carried forward."""
    person = customer_state(customer_changes(customers), start, end)
    place = location_state(location_changes(locations), start, end)
    return dim_customers_of(person, reference, place, start, end)


def dim_customers_of(
    person: DataFrame, reference: DataFrame, place: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Customers of each day from the states of that day."""
    person, place = in_days(person, start, end), in_days(place, start, end).drop("changed_on")
    erp = in_days(reference, start, end).select("CID", "BDATE", "GEN", SNAPSHOT)
    p, e, l = person.alias("p"), erp.alias("e"), place.alias("l")
    joined = p.join(
        e, (F.col("p.cst_key") == F.col("e.CID")) & (F.col(f"p.{SNAPSHOT}") == F.col(f"e.{SNAPSHOT}")),
        "left",
    ).join(
        l, (F.col("p.cst_key") == F.col("l.CID")) & (F.col(f"p.{SNAPSHOT}") == F.col(f"l.{SNAPSHOT}")),
        "left",
    )
    merged = joined.select(
        F.col("p.cst_id").alias("customer_id"),
        F.col("p.cst_key").alias("customer_number"),
        F.col("p.cst_firstname").alias("first_name"),
        F.col("p.cst_lastname").alias("last_name"),
        F.col("l.CNTRY").alias("country"),
        F.col("p.cst_marital_status").alias("marital_status"),
        first_known(F.col("p.cst_gndr"), F.col("e.GEN")).alias("gender"),
        F.col("e.BDATE").alias("birth_date"),
        F.col("p.cst_create_date").alias("create_date"),
        F.col(f"p.{SNAPSHOT}").alias(SNAPSHOT),
    )
    keyed = surrogate_key(merged, "customer_key", ["customer_id"], within=[SNAPSHOT])
    return with_load_time(keyed)


def dim_products_history(
    products: DataFrame,
    taxonomy: DataFrame,
    start: dt.date,
    end: dt.date,
    known: Sequence[dt.date] | None = None,
) -> DataFrame:
    """All product versions of the snapshot in effect on each day, with their category.

    ``known`` lists the days with staged products where the caller has them from a catalog.
    """
    staged = products.drop("dwh_create_date").withColumnRenamed(SNAPSHOT, "staged_on")
    versions = bridge_to_days(staged, "staged_on", SNAPSHOT, start, end, known).alias("v")
    categories = in_days(taxonomy, start, end).alias("t")
    joined = versions.join(
        categories,
        (F.col("v.cat_id") == F.col("t.ID")) & (F.col(f"v.{SNAPSHOT}") == F.col(f"t.{SNAPSHOT}")),
        "left",
    )
    merged = joined.select(
        F.col("v.prd_id").alias("product_id"),
        F.col("v.prd_key").alias("product_number"),
        F.col("v.prd_nm").alias("product_name"),
        F.col("v.prd_line").alias("product_line"),
        F.col("v.cat_id").alias("category_id"),
        F.col("t.CAT").alias("category"),
        F.col("t.SUBCAT").alias("subcategory"),
        F.col("t.MAINTENANCE").alias("maintenance"),
        F.col("v.prd_cost").alias("cost"),
        F.col("v.prd_start_dt").alias("start_date"),
        F.col("v.prd_end_dt").alias("end_date"),
        F.col("v.prd_end_dt").isNull().alias("is_current"),
        F.col(f"v.{SNAPSHOT}").alias(SNAPSHOT),
    )
    keyed = surrogate_key(
        merged, "product_key", ["start_date", "product_number", "product_id"], within=[SNAPSHOT]
    )
    return with_load_time(keyed)


def dim_products(history: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Current product versions only, one per product number."""
    return current_versions(
        in_days(history, start, end), [SNAPSHOT, "product_number"], "start_date"
    )


def fct_sales(
    sales: DataFrame, products: DataFrame, customers: DataFrame, start: dt.date, end: dt.date
) -> DataFrame:
    """Order lines with the keys of both dimensions; lines without a match keep NULL keys."""
    s = in_days(sales, start, end).alias("s")
    p = in_days(products, start, end).select("product_key", "product_number", SNAPSHOT).alias("p")
    c = in_days(customers, start, end).select("customer_key", "customer_id", SNAPSHOT).alias("c")
    joined = s.join(
        p,
        (F.col("s.sls_prd_key") == F.col("p.product_number"))
        & (F.col(f"s.{SNAPSHOT}") == F.col(f"p.{SNAPSHOT}")),
        "left",
    ).join(
        c,
        (F.col("s.sls_cust_id") == F.col("c.customer_id"))
        & (F.col(f"s.{SNAPSHOT}") == F.col(f"c.{SNAPSHOT}")),
        "left",
    )
    return with_load_time(
        joined.select(
            F.col("s.sls_ord_num").alias("order_number"),
            F.col("p.product_key").alias("product_key"),
            F.col("c.customer_key").alias("customer_key"),
            F.col("s.sls_order_dt").alias("order_date"),
            F.col("s.sls_ship_dt").alias("shipping_date"),
            F.col("s.sls_due_dt").alias("due_date"),
            F.col("s.sls_sales").alias("sales_amount"),
            F.col("s.sls_quantity").alias("quantity"),
            F.col("s.sls_price").alias("sls_price"),
            F.col(f"s.{SNAPSHOT}").alias(SNAPSHOT),
        )
    )
