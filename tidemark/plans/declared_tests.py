"""The data tests declared for every table, as fixed values."""

from __future__ import annotations

from tidemark.operators.quality import DataTest, NotNull, UniqueCombination

WARN = "warn"


def _unique(*columns: str, severity: str = "error") -> UniqueCombination:
    return UniqueCombination(columns, severity)


DECLARED: dict[str, list[DataTest]] = {
    "raw.sales_details": [NotNull("snapshot_date"), NotNull("sls_ord_num")],
    "raw.cust_info": [NotNull("snapshot_date"), NotNull("cst_id", WARN)],
    "raw.loc_a101": [NotNull("snapshot_date")],
    "raw.prd_info": [NotNull("snapshot_month"), NotNull("prd_id")],
    "staging.stg_crm_cust_info": [
        _unique("cst_id", "snapshot_date", severity=WARN),
        NotNull("cst_id", WARN),
        NotNull("cst_key"),
        NotNull("snapshot_date"),
    ],
    "staging.stg_crm_prd_info": [
        _unique("prd_id", "snapshot_date"),
        NotNull("prd_id"),
        NotNull("snapshot_date"),
    ],
    "staging.stg_crm_sales_details": [NotNull("sls_ord_num"), NotNull("snapshot_date")],
    "staging.stg_erp_CUST_AZ12": [
        _unique("CID", "snapshot_date", severity=WARN),
        NotNull("CID", WARN),
        NotNull("snapshot_date"),
    ],
    "staging.stg_erp_LOC_A101": [
        _unique("CID", "snapshot_date"),
        NotNull("CID"),
        NotNull("snapshot_date"),
    ],
    "staging.stg_erp_PX_CAT_G1V2": [
        _unique("ID", "snapshot_date"),
        NotNull("ID"),
        NotNull("snapshot_date"),
    ],
    "mart.dim_customers": [
        _unique("customer_key", "snapshot_date"),
        NotNull("customer_key"),
        NotNull("customer_id", WARN),
        NotNull("snapshot_date"),
    ],
    "mart.dim_products_history": [
        _unique("product_key", "snapshot_date"),
        NotNull("product_key"),
        NotNull("snapshot_date"),
    ],
    "mart.dim_products": [
        _unique("product_number", "snapshot_date"),
        NotNull("product_number"),
        NotNull("snapshot_date"),
    ],
    "mart.fct_sales": [NotNull("order_number"), NotNull("snapshot_date")],
    "reporting.rpt_sales_summary_by_customer": [
        _unique("customer_key", "snapshot_date"),
        NotNull("customer_key"),
        NotNull("snapshot_date"),
    ],
    "reporting.rpt_sales_performance_by_product": [
        _unique("product_key", "snapshot_date"),
        NotNull("product_key"),
        NotNull("snapshot_date"),
    ],
    "ml_features.customer_rfm": [
        _unique("customer_key", "snapshot_date"),
        NotNull("customer_key"),
        NotNull("customer_id"),
        NotNull("recency_days"),
        NotNull("frequency"),
        NotNull("monetary"),
        NotNull("snapshot_date"),
    ],
}
