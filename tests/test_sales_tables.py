from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import plan_of
from tidemark.queries import QUERIES, warehouse  # noqa: F401


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers, three parts of two product numbers, two orders, four lines; one line is of a part that is not there."""
    folder = str(tmp_path_factory.mktemp("tables"))
    day = dt.datetime(1998, 5, 4)
    rows = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(1, "Customer#1", 1, 0.0, "BUILDING"), (2, "Customer#2", 2, 0.0, "HOUSEHOLD")]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(1, "red", "Brand#1", "PROMO", 5, 9.0), (2, "blue", "Brand#1", "PROMO", 5, 9.0), (3, "tan", "Brand#2", "ECONOMY", 7, 4.0)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
                   [(1, 1, "O", 1.0, day, "1-URGENT"), (2, 2, "F", 1.0, day, "2-HIGH")]),
        "lineitem": ("l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp",
                     [(1, 1, 1, 3.0, "N", day), (1, 3, 5, 2.0, "N", day), (2, 2, 1, 4.0, "R", day), (2, 9, 2, 1.0, "N", day)]),
    }
    for name, (schema, values) in rows.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name", ["table_fct_sales", "table_rpt_sales_summary_by_customer", "table_rpt_sales_performance_by_product"]
)
def test_a_small_product_dimension_moves_no_order_lines(spark, tables, name):
    plan = plan_of(QUERIES[name](spark, tables))
    assert "FileScan parquet" in plan and "hashpartitioning(sls_prd_key" not in plan


@pytest.mark.parametrize(
    "name", ["table_fct_sales", "table_rpt_sales_summary_by_customer", "table_rpt_sales_performance_by_product"]
)
def test_a_small_customer_dimension_moves_no_order_lines(spark, tables, name):
    """The size of the stored table decides, not an estimate over the joins that made it."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "16KB")
    try:
        plan = plan_of(QUERIES[name](spark, tables))
    finally:
        spark.conf.set(setting, before)
    assert "FileScan parquet" in plan and "hashpartitioning(sls_cust_id" not in plan


def test_lines_find_their_part_order_and_keys(spark, tables):
    found = QUERIES["table_fct_sales"](spark, tables).collect()
    lines = sorted((r.order_number, r.quantity, r.sales_amount, r.sls_price) for r in found)
    assert lines == [("SO1", 2, 10, 5.0), ("SO1", 3, 3, 1.0), ("SO2", 4, 4, 1.0)]
    assert all(r.customer_key is not None and r.product_key is not None for r in found)
    assert len({r.product_key for r in found}) == 2
