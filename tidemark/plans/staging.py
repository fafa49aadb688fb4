"""Staging tables: typed, cleansed copies of the sources for the days ``start..end``.

Each function returns the rows of every day in the range, so one call with a single day
rebuilds a partition and one call with a range backfills all of them in one job.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import cleansing as c
from tidemark.operators.latest import latest_per_key
from tidemark.operators.timeline import (
    bridge_to_days,
    daily_state,
    partition_days,
    reachable_snapshots,
    scd2_close_out,
    stamp_days,
)

SNAPSHOT = "snapshot_date"
MONTH = "snapshot_month"


def in_days(df: DataFrame, start: dt.date, end: dt.date, day: str = SNAPSHOT) -> DataFrame:
    """Partitions of the range; literals, so they prune the scan."""
    if start == end:
        return df.where(F.col(day) == F.lit(start))
    return df.where(F.col(day).between(F.lit(start), F.lit(end)))


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("dwh_create_date", F.current_timestamp())


def crm_cust_info(raw: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Customers, one row per id and snapshot: the newest creation date wins."""
    cleaned = in_days(raw, start, end).select(
        F.col("cst_id").cast("int").alias("cst_id"),
        F.col("cst_key").cast("string").alias("cst_key"),
        F.trim("cst_firstname").alias("cst_firstname"),
        F.trim("cst_lastname").alias("cst_lastname"),
        c.standard_code(F.col("cst_marital_status"), c.MARITAL_STATUS).alias("cst_marital_status"),
        c.standard_code(F.col("cst_gndr"), c.GENDER_CODE).alias("cst_gndr"),
        F.col("cst_create_date").cast("date").alias("cst_create_date"),
        F.col(SNAPSHOT).cast("date").alias(SNAPSHOT),
    )
    return with_load_time(latest_per_key(cleaned, ["cst_id", SNAPSHOT], ["cst_create_date"]))


def crm_prd_info(
    raw: DataFrame,
    start: dt.date,
    end: dt.date,
    changes_only: bool = False,
    known: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Products of the monthly snapshot in effect on each day, with derived end dates.

    A monthly file is the whole product list: versions are closed out once per snapshot and
    then spread over its days. With ``changes_only`` a file holds only new or changed
    products, and earlier months carry forward. ``known`` lists the months where the caller has
    them from a catalog; otherwise the table is read for them.
    """
    if changes_only:
        typed = _typed_products(raw.where(F.col(MONTH) <= F.lit(end)))
        daily = daily_state(typed, ["prd_id"], MONTH, start, end, state_day=SNAPSHOT).drop(MONTH)
        return with_load_time(_closed_products(daily, SNAPSHOT))
    months = partition_days(raw, MONTH) if known is None else known
    typed = _typed_products(reachable_snapshots(raw, MONTH, months, start, end))
    daily = bridge_to_days(_closed_products(typed, MONTH), MONTH, SNAPSHOT, start, end, known=months)
    return with_load_time(daily.drop(MONTH))


def _typed_products(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("prd_id").cast("int").alias("prd_id"),
        c.key_head(F.col("prd_key")).alias("cat_id"),
        c.key_tail(F.col("prd_key")).alias("prd_key"),
        F.col("prd_nm").cast("string").alias("prd_nm"),
        F.coalesce(F.col("prd_cost").cast("int"), F.lit(0)).alias("prd_cost"),
        c.standard_code(F.col("prd_line"), c.PRODUCT_LINE).alias("prd_line"),
        F.col("prd_start_dt").cast("date").alias("prd_start_dt"),
        F.col(MONTH).cast("date").alias(MONTH),
    )


def _closed_products(products: DataFrame, within: str) -> DataFrame:
    return scd2_close_out(
        products, [within, "prd_key"], "prd_start_dt", ["prd_id"], end="prd_end_dt", current=None
    )


def crm_sales_details(raw: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Order lines with real dates and consistent amounts."""
    typed = in_days(raw, start, end).select(
        F.col("sls_ord_num").cast("string").alias("sls_ord_num"),
        F.replace(F.col("sls_prd_key").cast("string"), F.lit("-"), F.lit("_")).alias("sls_prd_key"),
        F.col("sls_cust_id").cast("int").alias("sls_cust_id"),
        *[c.guarded_date(F.col(d)).alias(d) for d in ("sls_order_dt", "sls_ship_dt", "sls_due_dt")],
        *[F.col(a).cast("int").alias(a) for a in ("sls_sales", "sls_quantity", "sls_price")],
        F.col(SNAPSHOT).cast("date").alias(SNAPSHOT),
    )
    return with_load_time(c.repair_amounts(typed, "sls_sales", "sls_quantity", "sls_price"))


def erp_cust_az12(
    seed: DataFrame, start: dt.date, end: dt.date, today: dt.date | None = None
) -> DataFrame:
    """Static customer reference, stamped onto every day. ``today`` bounds birth dates."""
    clock = F.lit(today) if today else F.current_date()
    cleaned = seed.select(
        c.key_by_length(F.col("CID").cast("string")).alias("CID"),
        c.no_future(F.col("BDATE").cast("date"), clock).alias("BDATE"),
        c.standard_code(F.col("GEN"), c.GENDER_WORD).alias("GEN"),
    )
    return with_load_time(stamp_days(cleaned, SNAPSHOT, start, end))


def erp_loc_a101(raw: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Customer locations; not deduplicated, its uniqueness is tested instead."""
    cleaned = in_days(raw, start, end).select(
        F.replace(F.col("CID").cast("string"), F.lit("-"), F.lit("")).alias("CID"),
        c.standard_country(F.col("CNTRY")).alias("CNTRY"),
        F.col(SNAPSHOT).cast("date").alias(SNAPSHOT),
    )
    return with_load_time(cleaned)


def erp_px_cat(seed: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Static product taxonomy, stamped onto every day."""
    cleaned = seed.select(
        F.col("ID").cast("string").alias("ID"),
        *[F.trim(name).alias(name) for name in ("CAT", "SUBCAT", "MAINTENANCE")],
    )
    return with_load_time(stamp_days(cleaned, SNAPSHOT, start, end))
