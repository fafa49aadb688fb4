"""The warehouse tables, built by their plans from raw rows derived from the benchmark tables.

Orders play the customer and location change logs, customers and parts the static and
monthly sources, order lines one full sales snapshot. The SQL derives the same raw rows and
states each table on its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleansing import decode
from tidemark.plans import marts, reporting, staging
from tidemark.queries import query
from tidemark.queries.inputs import (
    ORDERS_AS_OF,
    day_number,
    order_span,
    orders,
    read,
)
from tidemark.scratch import materialize

DAY = ORDERS_AS_OF
FIRST_DAY = DAY - dt.timedelta(days=2)
MONTHS = (dt.date(1998, 4, 1), dt.date(1998, 5, 1))
BRIDGE = (dt.date(1998, 4, 28), dt.date(1998, 5, 3))


def _customer_number(key: str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.lpad(F.col(key).cast("string"), 8, "0"))


def raw_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    anonymous = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P")
    rank = F.substring("o_orderpriority", 1, 1)
    return orders(spark, sf_dir).select(
        F.when(~anonymous, F.col("o_custkey").cast("int")).alias("cst_id"),
        _customer_number("o_custkey", "AW").alias("cst_key"),
        F.concat(F.lit("  First "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("cst_firstname"),
        F.concat(F.lit(" Last"), F.col("o_custkey").cast("string")).alias("cst_lastname"),
        decode(F.col("o_orderstatus"), {"O": " s", "F": "M "}, "x").alias("cst_marital_status"),
        decode(rank, {"1": "f", "2": " M "}, "n/a").alias("cst_gndr"),
        F.col("day").alias("cst_create_date"),
        F.col("day").alias("snapshot_date"),
    )


def raw_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    rank = F.substring("o_orderpriority", 1, 1)
    country = decode(rank, {"1": "us ", "2": " USA", "3": "de", "4": ""}, " Spain ")
    return orders(spark, sf_dir).select(
        _customer_number("o_custkey", "AW-").alias("CID"),
        country.alias("CNTRY"),
        F.col("day").alias("snapshot_date"),
    )


def raw_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two monthly snapshots, the first without large parts."""
    key = F.concat_ws(
        "-", F.substring("p_type", 1, 2), F.substring("p_name", 1, 2), "p_brand", F.col("p_size").cast("string")
    )
    months = F.when(F.col("p_type") == "LARGE", F.array(F.lit(MONTHS[1]))).otherwise(
        F.array(*[F.lit(m) for m in MONTHS])
    )
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("prd_id"),
        key.alias("prd_key"),
        F.col("p_name").alias("prd_nm"),
        F.when(F.col("p_type") != "PROMO", F.round("p_retailprice").cast("int")).alias("prd_cost"),
        decode(F.col("p_size") % 5, {0: "m ", 1: " R", 2: "S", 3: "t"}, "").alias("prd_line"),
        F.date_add(F.lit(dt.date(1990, 1, 1)), (F.col("p_partkey") * 13 % 3000).cast("int")).alias("prd_start_dt"),
        F.lit(None).cast("date").alias("prd_end_dt"),
        F.explode(months).alias("snapshot_month"),
    )


def seed_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    cid = (
        F.when(segment.isin("BUILDING", "FURNITURE"), _customer_number("c_custkey", "NASAW"))
        .when(segment.isin("HOUSEHOLD", "MACHINERY"), _customer_number("c_custkey", "AW"))
        .otherwise(F.col("c_name"))
    )
    born = F.date_add(F.lit(dt.date(1930, 1, 1)), (F.col("c_custkey") * 37 % 30000).cast("int"))
    gender = decode(F.col("c_nationkey") % 5, {0: "Male", 1: "F", 2: " female ", 3: None}, "")
    return read(spark, sf_dir, "customer").select(
        cid.alias("CID"), born.alias("BDATE"), gender.alias("GEN")
    )


def seed_px_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxonomy in which small parts stand under ids that no product has."""
    known = read(spark, sf_dir, "part")
    kind = F.when(F.col("p_type") == "SMALL", F.lit("XX")).otherwise(F.substring("p_type", 1, 2))
    category = F.concat_ws("_", kind, F.substring("p_name", 1, 2))
    return known.groupBy(category.alias("ID")).agg(
        F.concat(F.lit(" "), F.max("p_type"), F.lit(" ")).alias("CAT"),
        F.min("p_name").alias("SUBCAT"),
        F.when(F.max("p_size") > 49, "Yes ").otherwise("No").alias("MAINTENANCE"),
    )


def raw_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Lines of an order leave the last join side by side, and few narrow columns are shuffled before.
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        (F.col("l_returnflag") == "R").alias("returned"),
        F.to_date("l_shipdate").alias("shipped"),
    )
    heads = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    parts = read(spark, sf_dir, "part").select(
        "p_partkey", F.concat_ws("-", "p_brand", F.col("p_size").cast("string")).alias("prd_key")
    )
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(
        heads, F.col("l_orderkey") == F.col("o_orderkey")
    )
    number, returned = F.col("l_linenumber"), F.col("returned")
    quantity = F.col("l_quantity").cast("int")
    ship = (
        F.when(number == 1, F.lit(0))
        .when(number == 2, F.year("shipped") * 10 + F.month("shipped"))
        .otherwise(day_number("shipped"))
    )
    sales = F.when(returned, None).when(number == 4, quantity * number + 1).otherwise(quantity * number)
    sold = F.when(number == 6, F.lit(0)).otherwise(quantity)
    price = F.when(number == 1, -number).when(number == 2, 0).when(number == 3, None).otherwise(number)
    return joined.select(
        F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
        F.col("prd_key").alias("sls_prd_key"),
        F.col("o_custkey").cast("int").alias("sls_cust_id"),
        day_number("day").cast("string").alias("sls_order_dt"),
        ship.cast("string").alias("sls_ship_dt"),
        F.when(~returned, day_number("shipped")).cast("string").alias("sls_due_dt"),
        sales.alias("sls_sales"),
        sold.alias("sls_quantity"),
        price.alias("sls_price"),
        F.lit(DAY).alias("snapshot_date"),
    )


WAREHOUSE_SQL = f"""
    WITH days AS (
        SELECT CAST(d AS DATE) AS day
        FROM generate_series(DATE '{FIRST_DAY}', DATE '{DAY}', INTERVAL 1 DAY) t(d)
    ), stg_cust AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (
                PARTITION BY snapshot_date, cst_id
                ORDER BY cst_create_date DESC NULLS LAST, cst_key DESC, cst_firstname DESC,
                         cst_lastname DESC, cst_marital_status DESC, cst_gndr DESC) AS rn
            FROM (
                SELECT CASE WHEN o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P' THEN NULL
                            ELSE CAST(o_custkey AS INTEGER) END AS cst_id,
                       'AW' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS cst_key,
                       'First ' || o_orderkey AS cst_firstname, 'Last' || o_custkey AS cst_lastname,
                       CASE o_orderstatus WHEN 'O' THEN 'Single' WHEN 'F' THEN 'Married'
                            ELSE 'N/A' END AS cst_marital_status,
                       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Female' WHEN '2' THEN 'Male'
                            ELSE 'N/A' END AS cst_gndr,
                       CAST(o_orderdate AS DATE) AS cst_create_date,
                       CAST(o_orderdate AS DATE) AS snapshot_date
                FROM orders
            )
        ) WHERE rn = 1
    ), stg_loc AS (
        SELECT 'AW' || lpad(CAST(o_custkey AS VARCHAR), 8, '0') AS CID,
               CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'United States'
                    WHEN '2' THEN 'United States' WHEN '3' THEN 'Germany' WHEN '4' THEN 'N/A'
                    ELSE 'Spain' END AS CNTRY,
               CAST(o_orderdate AS DATE) AS snapshot_date
        FROM orders
    ), stg_az AS (
        SELECT CID, CASE WHEN BDATE > DATE '{DAY}' THEN NULL ELSE BDATE END AS BDATE, GEN,
               day AS snapshot_date
        FROM (
            SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
                        THEN 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS CID,
                   DATE '1930-01-01' + CAST(c_custkey * 37 % 30000 AS INTEGER) AS BDATE,
                   CASE c_nationkey % 5 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'Female'
                        ELSE 'N/A' END AS GEN
            FROM customer
        ), days
    ), stg_px AS (
        SELECT CASE p_type WHEN 'SMALL' THEN 'XX' ELSE substr(p_type, 1, 2) END || '_' || substr(p_name, 1, 2) AS ID,
               max(p_type) AS CAT,
               min(p_name) AS SUBCAT, CASE WHEN max(p_size) > 49 THEN 'Yes' ELSE 'No' END AS MAINTENANCE,
               day AS snapshot_date
        FROM part, days GROUP BY 1, 5
    ), raw_prd AS (
        SELECT CAST(p_partkey AS INTEGER) AS prd_id,
               substr(p_type, 1, 2) || '_' || substr(p_name, 1, 2) AS cat_id,
               p_brand || '_' || p_size AS prd_key, p_name AS prd_nm,
               CASE WHEN p_type <> 'PROMO' THEN CAST(round(p_retailprice) AS INTEGER) ELSE 0 END
                   AS prd_cost,
               CASE p_size % 5 WHEN 0 THEN 'Mountain' WHEN 1 THEN 'Road' WHEN 2 THEN 'Other Sales'
                    WHEN 3 THEN 'Touring' ELSE 'N/A' END AS prd_line,
               DATE '1990-01-01' + CAST(p_partkey * 13 % 3000 AS INTEGER) AS prd_start_dt,
               snapshot_month
        FROM part, (VALUES (DATE '{MONTHS[0]}'), (DATE '{MONTHS[1]}')) m(snapshot_month)
        WHERE p_type <> 'LARGE' OR snapshot_month = DATE '{MONTHS[1]}'
    ), closed_prd AS (
        SELECT *, CAST(LEAD(prd_start_dt) OVER (PARTITION BY snapshot_month, prd_key
                                                ORDER BY prd_start_dt, prd_id)
                       - INTERVAL 1 DAY AS DATE) AS prd_end_dt
        FROM raw_prd
    ), stg_prd AS (
        SELECT p.* EXCLUDE (snapshot_month), CAST(d AS DATE) AS snapshot_date
        FROM generate_series(DATE '{BRIDGE[0]}', DATE '{BRIDGE[1]}', INTERVAL 1 DAY) t(d)
        JOIN closed_prd p ON p.snapshot_month = date_trunc('month', d)
    ), typed_sales AS (
        SELECT 'SO' || l_orderkey AS sls_ord_num, p_brand || '_' || p_size AS sls_prd_key,
               CAST(o_custkey AS INTEGER) AS sls_cust_id, CAST(o_orderdate AS DATE) AS sls_order_dt,
               CASE WHEN l_linenumber > 2 THEN CAST(l_shipdate AS DATE) END AS sls_ship_dt,
               CASE WHEN l_returnflag <> 'R' THEN CAST(l_shipdate AS DATE) END AS sls_due_dt,
               CASE WHEN l_returnflag <> 'R'
                    THEN CAST(l_quantity * l_linenumber AS INTEGER)
                         + CASE WHEN l_linenumber = 4 THEN 1 ELSE 0 END END AS sales,
               CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
               CASE l_linenumber WHEN 2 THEN 0 WHEN 3 THEN NULL ELSE l_linenumber END AS price
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
    ), repaired_sales AS (
        SELECT *, CASE WHEN sales > 0 AND (sales = quantity * price) IS NOT FALSE
                       THEN sales ELSE quantity * price END AS fixed
        FROM typed_sales
    ), stg_sales AS (
        SELECT sls_ord_num, sls_prd_key, sls_cust_id, sls_order_dt, sls_ship_dt, sls_due_dt,
               CAST(fixed AS INTEGER) AS sls_sales, quantity AS sls_quantity,
               CAST(COALESCE(NULLIF(price, 0), fixed / NULLIF(quantity, 0), price) AS DOUBLE) AS sls_price,
               DATE '{DAY}' AS snapshot_date
        FROM repaired_sales
    ), person AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT c.* EXCLUDE (snapshot_date), day,
                   ROW_NUMBER() OVER (PARTITION BY cst_id, day ORDER BY snapshot_date DESC) AS rn
            FROM stg_cust c JOIN days ON snapshot_date <= day
        ) WHERE rn = 1
    ), place AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT CID, CNTRY, day, ROW_NUMBER() OVER (PARTITION BY CID, day
                       ORDER BY snapshot_date DESC, CNTRY DESC) AS rn
            FROM stg_loc JOIN days ON snapshot_date <= day
        ) WHERE rn = 1
    ), dim_customers AS (
        SELECT ROW_NUMBER() OVER (PARTITION BY p.day ORDER BY cst_id NULLS LAST) AS customer_key,
               cst_id AS customer_id, cst_key AS customer_number, cst_firstname AS first_name,
               cst_lastname AS last_name, CNTRY AS country, cst_marital_status AS marital_status,
               COALESCE(NULLIF(cst_gndr, 'N/A'), NULLIF(GEN, 'N/A'), 'N/A') AS gender,
               BDATE AS birth_date, cst_create_date AS create_date, p.day AS snapshot_date
        FROM person p LEFT JOIN stg_az a ON a.CID = cst_key AND a.snapshot_date = p.day
                      LEFT JOIN place l ON l.CID = cst_key AND l.day = p.day
    ), dim_products_history AS (
        SELECT ROW_NUMBER() OVER (PARTITION BY day ORDER BY prd_start_dt, prd_key, prd_id) AS product_key,
               prd_id AS product_id, prd_key AS product_number, prd_nm AS product_name,
               prd_line AS product_line, cat_id AS category_id, CAT AS category, SUBCAT AS subcategory,
               MAINTENANCE AS maintenance, prd_cost AS cost, prd_start_dt AS start_date,
               prd_end_dt AS end_date, prd_end_dt IS NULL AS is_current, day AS snapshot_date
        FROM closed_prd JOIN days ON snapshot_month = DATE '{MONTHS[1]}'
             LEFT JOIN stg_px x ON x.ID = cat_id AND x.snapshot_date = day
    ), dim_products AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_date, product_number
                                         ORDER BY start_date DESC, product_key DESC) AS rn
            FROM dim_products_history WHERE is_current
        ) WHERE rn = 1
    ), fct_sales AS (
        SELECT sls_ord_num AS order_number, product_key, customer_key, sls_order_dt AS order_date,
               sls_ship_dt AS shipping_date, sls_due_dt AS due_date, sls_sales AS sales_amount,
               sls_quantity AS quantity, sls_price, s.snapshot_date
        FROM stg_sales s
        LEFT JOIN dim_products p ON product_number = sls_prd_key AND p.snapshot_date = s.snapshot_date
        LEFT JOIN dim_customers c ON customer_id = sls_cust_id AND c.snapshot_date = s.snapshot_date
    ), rpt_customer AS (
        SELECT c.customer_key, customer_id, first_name, last_name, country, gender, marital_status,
               COUNT(order_number) AS total_orders, CAST(SUM(sales_amount) AS BIGINT) AS total_sales,
               CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold, AVG(sales_amount) AS avg_order_value,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date,
               date_diff('day', MIN(order_date), MAX(order_date)) AS days_since_first_order,
               f.snapshot_date
        FROM fct_sales f JOIN dim_customers c
             ON c.customer_key = f.customer_key AND c.snapshot_date = f.snapshot_date
        GROUP BY ALL
    ), rpt_product AS (
        SELECT p.product_key, product_id, product_number, product_name, product_line, category,
               subcategory, cost, COUNT(order_number) AS total_orders,
               CAST(SUM(sales_amount) AS BIGINT) AS total_sales,
               CAST(SUM(quantity) AS BIGINT) AS total_quantity_sold,
               AVG(sales_amount) AS avg_sales_per_order, round(AVG(sls_price), 6) AS avg_unit_price,
               CAST(SUM(quantity * cost) AS BIGINT) AS total_cost,
               CAST(SUM(sales_amount - quantity * cost) AS BIGINT) AS total_profit,
               MIN(order_date) AS first_sale_date, MAX(order_date) AS last_sale_date, f.snapshot_date
        FROM fct_sales f JOIN dim_products p
             ON p.product_key = f.product_key AND p.snapshot_date = f.snapshot_date
        GROUP BY ALL
    )
"""


def _staged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products staged on the first days of the two months, as a daily build leaves them."""
    raw = raw_prd_info(spark, sf_dir)
    first, second = [staging.crm_prd_info(raw, month, month) for month in MONTHS]
    return materialize(first.unionByName(second), "products")


def _customers(spark: SparkSession, sf_dir: str, start: dt.date, end: dt.date) -> DataFrame:
    return marts.dim_customers(
        staging.crm_cust_info(raw_cust_info(spark, sf_dir), *order_span(spark, sf_dir)),
        staging.erp_cust_az12(seed_cust_az12(spark, sf_dir), start, end, today=DAY),
        staging.erp_loc_a101(raw_loc_a101(spark, sf_dir), *order_span(spark, sf_dir)),
        start,
        end,
    )


def _history(spark: SparkSession, sf_dir: str, start: dt.date, end: dt.date) -> DataFrame:
    taxonomy = staging.erp_px_cat(seed_px_cat(spark, sf_dir), start, end)
    return marts.dim_products_history(_staged_products(spark, sf_dir), taxonomy, start, end)


def _products(spark: SparkSession, sf_dir: str, start: dt.date, end: dt.date) -> DataFrame:
    return marts.dim_products(_history(spark, sf_dir, start, end), start, end)


def _stored_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products of the day as a daily build leaves them: of known size, so that a small dimension moves no fact rows."""
    return materialize(_products(spark, sf_dir, DAY, DAY), "dim-products")


def _stored_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the day as a daily build leaves them: of known size, so that order lines need not be shuffled by customer."""
    return materialize(_customers(spark, sf_dir, DAY, DAY), "dim-customers")


def _sales(spark: SparkSession, sf_dir: str, products: DataFrame, customers: DataFrame) -> DataFrame:
    sales = staging.crm_sales_details(raw_sales_details(spark, sf_dir), DAY, DAY)
    return marts.fct_sales(sales, products, customers, DAY, DAY)


def _plain(df: DataFrame) -> DataFrame:
    """Without the load time, which differs between runs."""
    return df.drop("dwh_create_date")


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_cust")
def table_stg_crm_cust_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.crm_cust_info(raw_cust_info(spark, sf_dir), *order_span(spark, sf_dir)))


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_prd")
def table_stg_crm_prd_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.crm_prd_info(raw_prd_info(spark, sf_dir), *BRIDGE))


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_sales")
def table_stg_crm_sales_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.crm_sales_details(raw_sales_details(spark, sf_dir), DAY, DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_az")
def table_stg_erp_cust_az12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.erp_cust_az12(seed_cust_az12(spark, sf_dir), FIRST_DAY, DAY, today=DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_loc")
def table_stg_erp_loc_a101(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.erp_loc_a101(raw_loc_a101(spark, sf_dir), *order_span(spark, sf_dir)))


@query(f"{WAREHOUSE_SQL} SELECT * FROM stg_px")
def table_stg_erp_px_cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(staging.erp_px_cat(seed_px_cat(spark, sf_dir), FIRST_DAY, DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM dim_customers")
def table_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_customers(spark, sf_dir, FIRST_DAY, DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM dim_products_history")
def table_dim_products_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_history(spark, sf_dir, FIRST_DAY, DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM dim_products")
def table_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_products(spark, sf_dir, FIRST_DAY, DAY))


@query(f"{WAREHOUSE_SQL} SELECT * FROM fct_sales")
def table_fct_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, customers = _stored_products(spark, sf_dir), _stored_customers(spark, sf_dir)
    return _plain(_sales(spark, sf_dir, products, customers))


@query(f"{WAREHOUSE_SQL} SELECT * FROM rpt_customer")
def table_rpt_sales_summary_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, customers = _stored_products(spark, sf_dir), _stored_customers(spark, sf_dir)
    fact = _sales(spark, sf_dir, products, customers)
    return reporting.sales_summary_by_customer(fact, customers, DAY, DAY)


@query(f"{WAREHOUSE_SQL} SELECT * FROM rpt_product")
def table_rpt_sales_performance_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    products, customers = _stored_products(spark, sf_dir), _stored_customers(spark, sf_dir)
    fact = _sales(spark, sf_dir, products, customers)
    report = reporting.sales_performance_by_product(fact, products, DAY, DAY)
    return report.withColumn("avg_unit_price", F.round("avg_unit_price", 6))


@query(f"""{WAREHOUSE_SQL}
    SELECT customer_key, customer_id, first_name, last_name, country,
           CAST(date_diff('day', last_order_date, snapshot_date) AS INTEGER) AS recency_days,
           CAST(total_orders AS INTEGER) AS frequency, CAST(total_sales AS DOUBLE) AS monetary,
           snapshot_date AS features_as_of_date, snapshot_date
    FROM rpt_customer WHERE last_order_date IS NOT NULL
""")
def table_customer_rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(reporting.customer_rfm(table_rpt_sales_summary_by_customer(spark, sf_dir), DAY, DAY))
