"""Casts, code lists, key rules, date guards and amount repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import cleansing as c
from tidemark.operators.timeline import stamp_days
from tidemark.queries import query
from tidemark.queries.inputs import (
    EVENTS_AS_OF,
    EVENTS_LAST,
    ORDERS_AS_OF,
    cents,
    day_number,
    orders,
    read,
)
from tidemark.sources.landing import stamp_partition as fill_partition


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(l_orderkey AS VARCHAR) AS order_text,
           CAST(l_quantity AS INTEGER) AS quantity_int,
           CAST(l_extendedprice AS INTEGER) AS price_int,
           CAST(l_linenumber AS DOUBLE) AS line_double,
           CAST(l_shipdate AS DATE) AS ship_day,
           CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS ship_text,
           CAST(CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS TIMESTAMP) AS ship_ts,
           TRY_CAST(CASE WHEN l_linestatus = 'O' THEN CAST(l_linenumber AS VARCHAR)
                         ELSE l_returnflag END AS INTEGER) AS lenient_int
    FROM lineitem
""")
def typed_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    day = F.to_date("l_shipdate")
    mixed = F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("string")).otherwise(
        F.col("l_returnflag")
    )
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.col("l_orderkey").cast("string").alias("order_text"),
        F.col("l_quantity").cast("int").alias("quantity_int"),
        c.rounded_int(F.col("l_extendedprice")).alias("price_int"),
        F.col("l_linenumber").cast("double").alias("line_double"),
        day.alias("ship_day"),
        day.cast("string").alias("ship_text"),
        day.cast("string").cast("timestamp_ntz").alias("ship_ts"),
        mixed.try_cast("int").alias("lenient_int"),
    )


@query("""
    WITH raw AS (
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'O' THEN ' s' WHEN 'F' THEN 'M ' ELSE 'x' END AS marital,
               CASE substr(o_orderpriority, 1, 1)
                    WHEN '1' THEN 'f' WHEN '2' THEN ' M ' WHEN '3' THEN 'male' WHEN '4' THEN NULL
                    ELSE 'Female' END AS gender,
               CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'r ' WHEN 'MACHINERY' THEN 'M'
                    WHEN 'BUILDING' THEN ' s' WHEN 'AUTOMOBILE' THEN 'T ' ELSE '' END AS line,
               CASE n_nationkey WHEN 0 THEN 'us ' WHEN 1 THEN ' USA'
                    WHEN 2 THEN 'United States of America' WHEN 3 THEN 'uk' WHEN 4 THEN 'De'
                    WHEN 5 THEN 'FR' WHEN 6 THEN NULL WHEN 7 THEN '  ' WHEN 8 THEN 'n/a'
                    WHEN 9 THEN 'null' ELSE ' ' || n_name || ' ' END AS country
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
                    LEFT JOIN nation ON n_nationkey = c_nationkey
    )
    SELECT o_orderkey, COALESCE(ms.label, 'N/A') AS marital_status,
           COALESCE(gc.label, 'N/A') AS gender_of_code, COALESCE(gw.label, 'N/A') AS gender_of_word,
           COALESCE(pl.label, 'N/A') AS product_line,
           COALESCE(cn.label, NULLIF(CASE upper(trim(country)) WHEN 'N/A' THEN '' ELSE trim(country) END, ''),
                    'N/A') AS country
    FROM raw
    LEFT JOIN (VALUES ('S', 'Single'), ('M', 'Married')) ms(code, label) ON ms.code = upper(trim(marital))
    LEFT JOIN (VALUES ('F', 'Female'), ('M', 'Male')) gc(code, label) ON gc.code = upper(trim(gender))
    LEFT JOIN (VALUES ('F', 'Female'), ('FEMALE', 'Female'), ('M', 'Male'), ('MALE', 'Male'))
              gw(code, label) ON gw.code = upper(trim(gender))
    LEFT JOIN (VALUES ('M', 'Mountain'), ('R', 'Road'), ('S', 'Other Sales'), ('T', 'Touring'))
              pl(code, label) ON pl.code = upper(trim(line))
    LEFT JOIN (VALUES ('US', 'United States'), ('USA', 'United States'),
                      ('UNITED STATES OF AMERICA', 'United States'), ('UK', 'United Kingdom'),
                      ('DE', 'Germany'), ('FR', 'France')) cn(code, label)
              ON cn.code = upper(trim(country))
""")
def standardize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    people = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    joined = sales.join(people, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    marital = c.decode(F.col("o_orderstatus"), {"O": " s", "F": "M "}, "x")
    rank = F.substring("o_orderpriority", 1, 1)
    gender = c.decode(rank, {"1": "f", "2": " M ", "3": "male", "4": None}, "Female")
    segments = {"HOUSEHOLD": "r ", "MACHINERY": "M", "BUILDING": " s", "AUTOMOBILE": "T "}
    line = c.decode(F.col("c_mktsegment"), segments, "")
    country = c.decode(
        F.col("n_nationkey"),
        {0: "us ", 1: " USA", 2: "United States of America", 3: "uk", 4: "De", 5: "FR", 6: None,
         7: "  ", 8: "n/a", 9: "null"},
        F.concat(F.lit(" "), "n_name", F.lit(" ")),
    )
    return joined.select(
        "o_orderkey",
        c.standard_code(marital, c.MARITAL_STATUS).alias("marital_status"),
        c.standard_code(gender, c.GENDER_CODE).alias("gender_of_code"),
        c.standard_code(gender, c.GENDER_WORD).alias("gender_of_word"),
        c.standard_code(line, c.PRODUCT_LINE).alias("product_line"),
        c.standard_country(country).alias("country"),
    )


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CASE l_returnflag WHEN 'R' THEN 'Returned' WHEN 'A' THEN 'Accepted' ELSE 'N/A' END
               AS return_label,
           CASE l_linestatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Filled' ELSE 'N/A' END
               AS status_label,
           COALESCE(CASE WHEN p_type <> 'PROMO'
                         THEN CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) END, 0) AS cost
    FROM lineitem LEFT JOIN part ON p_partkey = l_partkey
""")
def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    cost = F.when(F.col("p_type") != "PROMO", cents("p_retailprice")).alias("cost")
    parts = read(spark, sf_dir, "part").select("p_partkey", cost)
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    returned = c.decode(F.col("l_returnflag"), {"R": "Returned", "A": "Accepted"}, c.NOT_AVAILABLE)
    status = c.decode(F.col("l_linestatus"), {"O": "Open", "F": "Filled"}, c.NOT_AVAILABLE)
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        returned.alias("return_label"),
        status.alias("status_label"),
        F.coalesce("cost", F.lit(0)).cast("bigint").alias("cost"),
    )


@query("""
    WITH raw AS (
        SELECT p_partkey, substr(p_type, 1, 2) || '-' || substr(p_name, 1, 2) || '-' || p_brand
                          || '-' || p_size AS prd_key
        FROM part
    )
    SELECT p_partkey, replace(substr(prd_key, 1, 5), '-', '_') AS category_id,
           replace(substr(prd_key, 7), '-', '_') AS product_number
    FROM raw
""")
def key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.concat_ws(
        "-", F.substring("p_type", 1, 2), F.substring("p_name", 1, 2), "p_brand", F.col("p_size").cast("string")
    )
    keyed = read(spark, sf_dir, "part").select("p_partkey", key.alias("prd_key"))
    return keyed.select(
        "p_partkey",
        c.key_head(F.col("prd_key")).alias("category_id"),
        c.key_tail(F.col("prd_key")).alias("product_number"),
    )


@query("""
    WITH raw AS (
        SELECT c_custkey,
               CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE')
                         THEN 'NASAW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                    WHEN c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
                         THEN 'AW' || lpad(CAST(c_custkey AS VARCHAR), 8, '0')
                    ELSE c_name END AS cid
        FROM customer
    )
    SELECT c_custkey,
           CASE WHEN length(cid) = 13 THEN substr(cid, 4) WHEN length(cid) = 10 THEN cid END AS cid
    FROM raw
""")
def normalize_key_by_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    segment = F.col("c_mktsegment")
    raw = (
        F.when(segment.isin("BUILDING", "FURNITURE"), F.concat(F.lit("NASAW"), number))
        .when(segment.isin("HOUSEHOLD", "MACHINERY"), F.concat(F.lit("AW"), number))
        .otherwise(F.col("c_name"))
    )
    return read(spark, sf_dir, "customer").select("c_custkey", c.key_by_length(raw).alias("cid"))


@query("""
    WITH raw AS (
        SELECT o_orderkey, o_orderpriority,
               CASE substr(o_orderpriority, 1, 1)
                    WHEN '1' THEN strftime(o_orderdate, '%Y%m%d') WHEN '2' THEN '0'
                    WHEN '3' THEN NULL WHEN '4' THEN strftime(o_orderdate, '-%Y%m0')
                    ELSE CASE o_orderstatus WHEN 'P' THEN strftime(o_orderdate, '%Y%m')
                              ELSE strftime(o_orderdate, '%Y%m%d') END END AS stamp,
               strftime(o_orderdate, '%Y%d') || substr(strftime(o_orderdate, '%m'), 1, 2) AS swapped
        FROM orders
    )
    SELECT o_orderkey,
           CASE WHEN CAST(stamp AS INTEGER) > 0 AND length(stamp) = 8
                THEN CAST(strptime(stamp, '%Y%m%d') AS DATE) END AS order_day,
           CASE WHEN CAST(swapped AS INTEGER) > 0 AND length(swapped) = 8
                THEN CAST(try_strptime(swapped, '%Y%m%d') AS DATE) END AS lenient_day
    FROM raw
""")
def guarded_date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strict parsing of guarded numbers, lenient parsing of numbers with impossible months."""
    sales = orders(spark, sf_dir)
    rank = F.substring("o_orderpriority", 1, 1)
    year, month = F.year("day"), F.month("day")
    unfinished = F.col("o_orderstatus") == "P"
    stamp = (
        F.when(rank == "1", day_number("day"))
        .when(rank == "2", F.lit(0))
        .when(rank == "3", F.lit(None))
        .when(rank == "4", -(year * 1000 + month * 10))
        .otherwise(F.when(unfinished, year * 100 + month).otherwise(day_number("day")))
    ).cast("string")
    swapped = (year * 10000 + F.dayofmonth("day") * 100 + month).cast("string")
    return sales.select(
        "o_orderkey",
        c.guarded_date(stamp).alias("order_day"),
        c.guarded_date(swapped, strict=False).alias("lenient_day"),
    )


@query("""
    WITH raw AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
               CASE WHEN l_returnflag = 'R' THEN NULL
                    WHEN l_linenumber = 4 THEN CAST(l_quantity * l_linenumber AS BIGINT) + 1
                    WHEN l_linenumber = 5 THEN -CAST(l_quantity AS BIGINT)
                    ELSE CAST(l_quantity * l_linenumber AS BIGINT) END AS sales,
               CASE WHEN l_linenumber = 6 THEN 0
                    WHEN l_linenumber = 7 AND l_linestatus = 'O' THEN NULL
                    ELSE CAST(l_quantity AS BIGINT) END AS quantity,
               CASE WHEN l_linenumber = 1 THEN -CAST(l_linenumber AS BIGINT)
                    WHEN l_linenumber = 2 THEN 0 WHEN l_linenumber = 3 THEN NULL
                    ELSE CAST(l_linenumber AS BIGINT) END AS price
        FROM lineitem
    ), sold AS (
        SELECT * REPLACE (abs(price) AS price,
                          CASE WHEN sales > 0 AND (sales = quantity * abs(price)) IS NOT FALSE
                               THEN sales ELSE quantity * abs(price) END AS sales)
        FROM raw
    )
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, sales, quantity,
           CAST(COALESCE(NULLIF(price, 0), sales / NULLIF(quantity, 0), price) AS DOUBLE) AS price
    FROM sold
""")
def repair_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    number = F.col("l_linenumber").cast("bigint")
    quantity = F.col("l_quantity").cast("bigint")
    sales = (
        F.when(F.col("l_returnflag") == "R", None)
        .when(number == 4, quantity * number + 1)
        .when(number == 5, -quantity)
        .otherwise(quantity * number)
    )
    open_line = F.col("l_linestatus") == "O"
    sold = F.when(number == 6, F.lit(0)).when((number == 7) & open_line, None).otherwise(quantity)
    price = F.when(number == 1, -number).when(number == 2, 0).when(number == 3, None).otherwise(number)
    broken = lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        sales.alias("sales"),
        sold.alias("quantity"),
        price.alias("price"),
    )
    return c.repair_amounts(broken, "sales", "quantity", "price")


@query(f"""
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) > DATE '{ORDERS_AS_OF}' THEN NULL
                            ELSE CAST(o_orderdate AS DATE) END AS order_day
    FROM orders
""")
def null_future_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        "o_orderkey", c.no_future(F.col("day"), F.lit(ORDERS_AS_OF)).alias("order_day")
    )


@query("""
    WITH raw AS (
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN 'Female' WHEN 'O' THEN 'Male' ELSE 'N/A' END AS first,
               CASE c_mktsegment WHEN 'FURNITURE' THEN 'Female' WHEN 'MACHINERY' THEN 'Male'
                    WHEN 'BUILDING' THEN 'N/A' END AS second
        FROM orders LEFT JOIN customer ON c_custkey = o_custkey
    )
    SELECT o_orderkey, COALESCE(NULLIF(first, 'N/A'), NULLIF(second, 'N/A'), 'N/A') AS gender
    FROM raw
""")
def coalesce_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus")
    people = read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = sales.join(people, F.col("o_custkey") == F.col("c_custkey"), "left")
    first = c.decode(F.col("o_orderstatus"), {"F": "Female", "O": "Male"}, c.NOT_AVAILABLE)
    known = {"FURNITURE": "Female", "MACHINERY": "Male", "BUILDING": c.NOT_AVAILABLE}
    second = c.decode(F.col("c_mktsegment"), known)
    return joined.select("o_orderkey", c.first_known(first, second).alias("gender"))


@query(f"""
    SELECT c_custkey, c_name, c_mktsegment, CAST(d AS DATE) AS snapshot_date
    FROM customer, generate_series(DATE '{EVENTS_AS_OF}', DATE '{EVENTS_LAST}', INTERVAL 1 DAY) t(d)
""")
def stamp_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of a range holds its own copy of the customers."""
    static = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return stamp_days(static, "snapshot_date", EVENTS_AS_OF, EVENTS_LAST)


@query(f"""
    SELECT o_orderkey,
           COALESCE(CAST(CASE WHEN o_orderstatus = 'O' THEN NULL
                              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS DATE),
                    DATE '{ORDERS_AS_OF}') AS snapshot_date
    FROM orders
""")
def fill_partition_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows keep their own date, given as text; rows without one get the partition's."""
    text = F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    rows = orders(spark, sf_dir).select("o_orderkey", text.alias("snapshot_date"))
    return fill_partition(rows, "snapshot_date", ORDERS_AS_OF)
