"""Schemas of landing files and of every table, as fixed values.

Raw dates that arrive as ``yyyyMMdd`` numbers stay text until staging parses them. All
tables but the two static ones are partitioned by their date column.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

RAW_TABLES = {
    "raw.sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt string, "
        "sls_ship_dt string, sls_due_dt string, sls_sales int, sls_quantity int, "
        "sls_price int, snapshot_date date"
    ),
    "raw.cust_info": (
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date, snapshot_date date"
    ),
    "raw.loc_a101": "CID string, CNTRY string, snapshot_date date",
    "raw.prd_info": (
        "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, "
        "prd_start_dt date, prd_end_dt date, snapshot_month date"
    ),
}

SEED_TABLES = {
    "seeds.CUST_AZ12": "CID string, BDATE date, GEN string",
    "seeds.PX_CAT_G1V2": "ID string, CAT string, SUBCAT string, MAINTENANCE string",
}

STAGING_TABLES = {
    "staging.stg_crm_cust_info": (
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date, "
        "dwh_create_date timestamp, snapshot_date date"
    ),
    "staging.stg_crm_prd_info": (
        "prd_id int, cat_id string, prd_key string, prd_nm string, prd_cost int, "
        "prd_line string, prd_start_dt date, prd_end_dt date, dwh_create_date timestamp, "
        "snapshot_date date"
    ),
    "staging.stg_crm_sales_details": (
        "sls_ord_num string, sls_prd_key string, sls_cust_id int, sls_order_dt date, "
        "sls_ship_dt date, sls_due_dt date, sls_sales int, sls_quantity int, "
        "sls_price double, dwh_create_date timestamp, snapshot_date date"
    ),
    "staging.stg_erp_CUST_AZ12": (
        "CID string, BDATE date, GEN string, dwh_create_date timestamp, snapshot_date date"
    ),
    "staging.stg_erp_LOC_A101": (
        "CID string, CNTRY string, dwh_create_date timestamp, snapshot_date date"
    ),
    "staging.stg_erp_PX_CAT_G1V2": (
        "ID string, CAT string, SUBCAT string, MAINTENANCE string, "
        "dwh_create_date timestamp, snapshot_date date"
    ),
}

_PRODUCT = (
    "product_key bigint, product_id int, product_number string, product_name string, "
    "product_line string, category_id string, category string, subcategory string, "
    "maintenance string, cost int, start_date date, end_date date, is_current boolean, "
    "dwh_create_date timestamp, snapshot_date date"
)

MART_TABLES = {
    "mart.dim_customers": (
        "customer_key bigint, customer_id int, customer_number string, first_name string, "
        "last_name string, country string, marital_status string, gender string, "
        "birth_date date, create_date date, dwh_create_date timestamp, snapshot_date date"
    ),
    "mart.dim_products_history": _PRODUCT,
    "mart.dim_products": _PRODUCT,
    "mart.fct_sales": (
        "order_number string, product_key bigint, customer_key bigint, order_date date, "
        "shipping_date date, due_date date, sales_amount int, quantity int, "
        "sls_price double, dwh_create_date timestamp, snapshot_date date"
    ),
}

REPORTING_TABLES = {
    "reporting.rpt_sales_summary_by_customer": (
        "customer_key bigint, customer_id int, first_name string, last_name string, "
        "country string, gender string, marital_status string, total_orders bigint, "
        "total_sales bigint, total_quantity_sold bigint, avg_order_value double, "
        "first_order_date date, last_order_date date, days_since_first_order bigint, "
        "snapshot_date date"
    ),
    "reporting.rpt_sales_performance_by_product": (
        "product_key bigint, product_id int, product_number string, product_name string, "
        "product_line string, category string, subcategory string, cost int, "
        "total_orders bigint, total_sales bigint, total_quantity_sold bigint, "
        "avg_sales_per_order double, avg_unit_price double, total_cost bigint, "
        "total_profit bigint, first_sale_date date, last_sale_date date, snapshot_date date"
    ),
}

ML_TABLES = {
    "ml_features.customer_rfm": (
        "customer_key bigint, customer_id int, first_name string, last_name string, "
        "country string, recency_days int, frequency int, monetary double, "
        "features_as_of_date date, dwh_create_date timestamp, snapshot_date date"
    ),
    "ml_features.customer_segments": (
        "customer_key bigint, customer_id int, recency_days int, frequency int, "
        "monetary double, segment_id int, segment_label string, snapshot_date date"
    ),
    "ml_features.churn_predictions": (
        "customer_key bigint, customer_id int, recency_days int, frequency int, "
        "monetary double, churn_probability double, is_high_risk boolean, snapshot_date date"
    ),
}

# Full state of the two change logs on every day, kept so that a day is built from the day before.
STATE_TABLES = {
    "state.customers": (
        "cst_id int, cst_key string, cst_firstname string, cst_lastname string, "
        "cst_marital_status string, cst_gndr string, cst_create_date date, changed_on date, "
        "snapshot_date date"
    ),
    "state.locations": "CID string, CNTRY string, changed_on date, snapshot_date date",
}

TABLES: dict[str, str] = {
    **RAW_TABLES,
    **SEED_TABLES,
    **STAGING_TABLES,
    **STATE_TABLES,
    **MART_TABLES,
    **REPORTING_TABLES,
    **ML_TABLES,
}

LAYERS = ("raw", "seeds", "staging", "state", "mart", "reporting", "ml_features")


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def partition_column(name: str) -> str | None:
    """The date column that partitions a table; None for static tables."""
    columns = table_schema(name).names
    return columns[-1] if columns[-1] in ("snapshot_date", "snapshot_month") else None
