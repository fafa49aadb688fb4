"""Benchmark tables written as snapshot files, landed in a warehouse and read back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import move_only_file, swap_folder
from tidemark.operators.quality import DataTestFailure
from tidemark.plans import daily
from tidemark.queries import query
from tidemark.queries.inputs import events, read
from tidemark.schemas import partition_column, table_schema
from tidemark.scratch import scratch_path
from tidemark.sinks.warehouse import Warehouse
from tidemark.sources.landing import snapshot_file
from tidemark.streaming.arrivals import ingest_changes

DAYS = tuple(dt.date(2024, 1, d) for d in (1, 2, 3))
MONTHS = (dt.date(2024, 1, 1), dt.date(2024, 2, 1))


def _store(spark: SparkSession) -> Warehouse:
    path = scratch_path(spark, "landed")
    return Warehouse(spark, path, prefix=f"landed_{path[-8:]}_")


def _files(df: DataFrame, names: dict[object, str], by: str, label: str) -> str:
    """Write the rows of each value of ``by`` as one CSV file of the given name; their folder."""
    spark = df.sparkSession
    folder = scratch_path(spark, label)
    parts = f"{folder}-parts"
    df.repartition(by).write.partitionBy(by).option("header", True).option("escape", '"').csv(parts)
    for value, name in names.items():
        move_only_file(spark, f"{parts}/{by}={value}", ".csv", f"{folder}/{name}")
    return folder


def _pick(number: str, *texts: Column) -> Column:
    """One of some texts, by a number."""
    picked = texts[-1]
    for i, text in enumerate(texts[:-1]):
        picked = F.when(F.expr(number) % len(texts) == i, text).otherwise(picked)
    return picked


@query("""
    SELECT CASE c_custkey % 4 WHEN 0 THEN NULL ELSE CAST(c_custkey AS INTEGER) END AS cst_id, c_name AS cst_key,
           CASE c_nationkey % 4 WHEN 3 THEN c_mktsegment END AS cst_firstname, c_mktsegment AS cst_lastname,
           'S' AS cst_marital_status, CASE c_nationkey % 3 WHEN 2 THEN 'F' END AS cst_gndr,
           CASE c_nationkey % 3 WHEN 2 THEN DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) END AS cst_create_date,
           DATE '2024-01-01' + CAST(c_custkey % 3 AS INTEGER) AS snapshot_date
    FROM customer
""")
def land_daily_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers in three daily files: missing markers, whole numbers with a fraction, days with a time."""
    number = F.col("c_custkey").cast("string")
    created = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("c_custkey") % 1000).cast("int")).cast("string")
    rows = read(spark, sf_dir, "customer").select(
        _pick("c_custkey", F.lit("NULL"), F.concat(number, F.lit(".0")), number, number).alias("cst_id"),
        F.col("c_name").alias("cst_key"),
        _pick("c_nationkey", F.lit("null"), F.lit("nan"), F.lit("N/A"), F.col("c_mktsegment")).alias("cst_firstname"),
        F.col("c_mktsegment").alias("cst_lastname"),
        F.lit("S").alias("cst_marital_status"),
        _pick("c_nationkey", F.lit("None"), F.lit("<NA>"), F.lit("F")).alias("cst_gndr"),
        _pick("c_nationkey", F.lit("NA"), F.lit(None).cast("string"), F.concat(created, F.lit(" 00:00:00"))).alias(
            "cst_create_date"
        ),
        (F.col("c_custkey") % 3).cast("int").alias("part"),
    )
    names = {i: snapshot_file("cust_info", day) for i, day in enumerate(DAYS)}
    folder, store = _files(rows, names, "part", "daily-files"), _store(spark)
    for day in DAYS:
        daily.land(store, folder, "cust_info", day)
    return store.table("raw.cust_info")


@query("""
    SELECT CAST(p_partkey AS INTEGER) AS prd_id, p_brand || chr(10) || p_size AS prd_key, p_name || ' "x"' AS prd_nm,
           CASE WHEN p_size % 5 > 0 THEN CAST(p_size AS INTEGER) END AS prd_cost, p_type AS prd_line,
           DATE '2010-01-01' + CAST(p_partkey % 3000 AS INTEGER) AS prd_start_dt, CAST(NULL AS DATE) AS prd_end_dt,
           month AS snapshot_month
    FROM part, (VALUES (DATE '2024-01-01'), (DATE '2024-02-01')) m(month)
""")
def land_monthly_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts in two monthly files, with line breaks and quotes inside fields."""
    start = F.date_add(F.lit(dt.date(2010, 1, 1)), (F.col("p_partkey") % 3000).cast("int"))
    rows = read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("prd_id"),
        F.concat("p_brand", F.lit("\n"), F.col("p_size").cast("string")).alias("prd_key"),
        F.concat("p_name", F.lit(' "x"')).alias("prd_nm"),
        F.when(F.col("p_size") % 5 == 0, "#N/A").otherwise(F.format_string("%d.0", "p_size")).alias("prd_cost"),
        F.col("p_type").alias("prd_line"),
        start.cast("string").alias("prd_start_dt"),
        F.lit("NaN").alias("prd_end_dt"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("part"),
    )
    names = {i: snapshot_file("prd_info", month) for i, month in enumerate(MONTHS)}
    folder, store = _files(rows, names, "part", "monthly-files"), _store(spark)
    for month in MONTHS:
        daily.land(store, folder, "prd_info", month, multi_line=True)
    return store.table("raw.prd_info")


@query("""
    SELECT CAST(n_nationkey AS VARCHAR) AS "ID", n_name AS "CAT", r_name AS "SUBCAT",
           CASE WHEN n_regionkey > 0 THEN 'Yes' END AS "MAINTENANCE"
    FROM nation JOIN region ON r_regionkey = n_regionkey
""")
def load_static_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a static reference file, loaded twice."""
    nations = read(spark, sf_dir, "nation").join(
        read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    rows = nations.select(
        F.col("n_nationkey").cast("string").alias("ID"),
        F.col("n_name").alias("CAT"),
        F.col("r_name").alias("SUBCAT"),
        F.when(F.col("n_regionkey") > 0, "Yes").otherwise("n/a").alias("MAINTENANCE"),
        F.lit(0).alias("part"),
    )
    folder, store = _files(rows, {0: "PX_CAT_G1V2.csv"}, "part", "static-file"), _store(spark)
    for _ in range(2):
        daily.load_seed(store, f"{folder}/PX_CAT_G1V2.csv", "seeds.PX_CAT_G1V2")
    return store.table("seeds.PX_CAT_G1V2")


@query("""
    SELECT c_name AS "CID", CASE WHEN c_custkey % 3 = 1 THEN 'corrected' ELSE c_mktsegment END AS "CNTRY",
           DATE '2024-01-01' + CAST(c_custkey % 3 AS INTEGER) AS snapshot_date
    FROM customer
""")
def relanded_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three daily files are landed, one is dropped again with other content, and what changed is landed."""
    rows = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("CID"), F.col("c_mktsegment").alias("CNTRY"), (F.col("c_custkey") % 3).cast("int").alias("part")
    )
    names = {i: snapshot_file("loc_a101", day) for i, day in enumerate(DAYS)}
    folder, store = _files(rows, names, "part", "dropped"), _store(spark)
    ledger = scratch_path(spark, "ledger")
    ingest_changes(store, folder, ledger)
    again = rows.where("part = 1").withColumn("CNTRY", F.lit("corrected"))
    corrected = _files(again, {1: names[1]}, "part", "dropped-again")
    swap_folder(spark, f"{corrected}/{names[1]}", f"{folder}/{names[1]}")
    changed = ingest_changes(store, folder, ledger)
    if [x.days for x in changed] != [(DAYS[1],)]:
        raise RuntimeError(f"landed again: {changed}")
    return store.table("raw.loc_a101")


@query("""
    WITH held AS (SELECT DISTINCT DATE '2024-01-01' + CAST(c_custkey % 60 AS INTEGER) AS day, c_custkey % 7 AS part FROM customer)
    SELECT day, day < DATE '2024-02-10' - 19 AS outside FROM held
    WHERE day <= DATE '2024-02-10' GROUP BY day
    HAVING count(*) FILTER (part <= 3) > 0 AND count(*) FILTER (part BETWEEN 1 AND 4) > 0
       AND count(*) FILTER (part BETWEEN 2 AND 5) > 0 AND count(*) FILTER (part = 4 AND day(day) % 3 = 0) = 0
       AND day >= (SELECT min(date_trunc('month', day)) FROM held WHERE part = 5)
""")
def due_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that three sources and the monthly list hold and the last report does not."""
    days = read(spark, sf_dir, "customer").select(
        F.date_add(F.lit(DAYS[0]), (F.col("c_custkey") % 60).cast("int")).alias("day"),
        (F.col("c_custkey") % 7).alias("part"),
    )
    store = _store(spark)
    held = {
        "raw.sales_details": ("part <= 3", F.col("day")),
        "raw.cust_info": ("part BETWEEN 1 AND 4", F.col("day")),
        "raw.loc_a101": ("part BETWEEN 2 AND 5", F.col("day")),
        "raw.prd_info": ("part = 5", F.trunc("day", "month")),
        "reporting.rpt_sales_performance_by_product": ("part = 4 AND day(day) % 3 = 0", F.col("day")),
    }
    for name, (condition, day) in held.items():
        column = partition_column(name)
        rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in table_schema(name) if f.name != column]
        store.replace_present(name, days.where(condition).select(*rest, day.alias(column)).distinct())
    return daily.due(store, dt.date(2024, 2, 10), lookback=20)


@query("""
    SELECT c_name AS "CID", CASE WHEN c_custkey % 3 = 0 THEN 'again' ELSE c_mktsegment END AS "CNTRY",
           DATE '2024-01-01' + CAST(c_custkey % 3 AS INTEGER) AS snapshot_date
    FROM customer
""")
def gated_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by day, written anew: one day well, one with repeated keys, one without keys; the bad ones stay as they were."""
    rows = read(spark, sf_dir, "customer").select(
        F.col("c_name").alias("CID"),
        F.col("c_mktsegment").alias("CNTRY"),
        F.lit(None).cast("timestamp").alias("dwh_create_date"),
        F.date_add(F.lit(DAYS[0]), (F.col("c_custkey") % 3).cast("int")).alias("snapshot_date"),
    )
    store, name = _store(spark), "staging.stg_erp_LOC_A101"
    daily.publish_tested(store, name, lambda: rows)
    again = rows.withColumn("CNTRY", F.lit("again"))
    days = [again.where(F.col("snapshot_date") == F.lit(day)) for day in DAYS]
    days[1] = days[1].unionByName(days[1].where("CID LIKE '%7'"))
    days[2] = days[2].withColumn("CID", F.when(~F.col("CID").endswith("7"), F.col("CID")))
    failed = 0
    for one_day in days:
        try:
            daily.publish_tested(store, name, lambda: one_day, many_days=False)
        except DataTestFailure:
            failed += 1
    if failed != 2 and rows.where("CID LIKE '%7'").select("snapshot_date").distinct().count() == 3:
        raise RuntimeError(f"{failed} days failed their tests")
    return store.table(name).drop("dwh_create_date")


@query("""
    SELECT 'raw.loc_a101' AS table_name, day, COUNT(*) AS row_count,
           COUNT(*) FILTER (WHERE event_type = 'error') AS null_countries
    FROM (SELECT CAST(ts AS DATE) AS day, event_type FROM events)
    WHERE day(day) % 5 > 0 OR event_type <> 'click' GROUP BY day
""")
def warehouse_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and NULLs of each day of the events, every fifth day written twice; from the version log."""
    rows = events(spark, sf_dir).select(
        F.col("user_id").cast("string").alias("CID"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("CNTRY"),
        F.col("day").alias("snapshot_date"),
    )
    store = _store(spark)
    store.replace_present("raw.loc_a101", rows)
    fifth = rows.where((F.dayofmonth("snapshot_date") % 5 == 0) & ~F.col("CNTRY").eqNullSafe("click"))
    store.replace_present("raw.loc_a101", fifth)
    return store.statistics("raw.loc_a101").select(
        "table_name", "day", "row_count", F.col("nulls")["CNTRY"].alias("null_countries")
    )
