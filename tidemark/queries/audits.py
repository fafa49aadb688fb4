"""Partition bookkeeping, partition-replacing writes, data tests and file routing."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import partitions, quality, summaries
from tidemark.operators.quality import NotNull, UniqueCombination
from tidemark.operators.staleness import partition_inputs, stale_partitions
from tidemark.queries import query
from tidemark.queries.inputs import EVENTS_AS_OF, events, order_span, orders, read
from tidemark.scratch import materialize, scratch_path
from tidemark.sinks.versions import HISTORY, NEWEST, SAME_DAY
from tidemark.sinks.warehouse import Warehouse, replace_partition_at, write_partitions
from tidemark.sources import routing

CLEARED = EVENTS_AS_OF + dt.timedelta(days=1)
NOW = dt.datetime(2024, 1, 31, 10, 30)


def daily_copy(spark: SparkSession, sf_dir: str) -> str:
    """The events as a table partitioned by day; returns its path."""
    path = scratch_path(spark, "events")
    write_partitions(events(spark, sf_dir), path, "day")
    return path


def read_back(spark: SparkSession, sf_dir: str, path: str) -> DataFrame:
    return spark.read.schema(events(spark, sf_dir).schema).parquet(path)


EVENTS_SQL = "SELECT user_id, ts, event_id, event_type, value, CAST(ts AS DATE) AS day FROM events"


@query(f"SELECT * FROM ({EVENTS_SQL}) WHERE day = DATE '{EVENTS_AS_OF}'")
def partition_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One partition of a table stored by day; the filter selects its directory."""
    stored = read_back(spark, sf_dir, daily_copy(spark, sf_dir))
    return stored.where(F.col("day") == F.lit(EVENTS_AS_OF))


@query(f"""
    SELECT user_id, ts, event_id, event_type,
           CASE WHEN day = DATE '{EVENTS_AS_OF}' THEN value * 2 ELSE value END AS value, day
    FROM ({EVENTS_SQL}) WHERE day <> DATE '{CLEARED}'
""")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day replaced by new values, the next one by no rows; all others untouched."""
    log = events(spark, sf_dir)
    path = daily_copy(spark, sf_dir)
    changed = log.where(F.col("day") == F.lit(EVENTS_AS_OF)).withColumn("value", F.col("value") * 2)
    replace_partition_at(changed, path, "day", EVENTS_AS_OF)
    replace_partition_at(log.where(F.lit(False)), path, "day", CLEARED)
    return read_back(spark, sf_dir, path)


@query(f"""
    SELECT * FROM ({EVENTS_SQL})
    WHERE day NOT IN (DATE '{EVENTS_AS_OF}', DATE '{CLEARED}') OR event_type = 'purchase'
""")
def replace_present_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days replaced by their purchases; writing no rows then changes nothing."""
    log = events(spark, sf_dir)
    path = daily_copy(spark, sf_dir)
    two_days = log.where(F.col("day").isin(EVENTS_AS_OF, CLEARED))
    write_partitions(two_days.where(F.col("event_type") == "purchase"), path, "day")
    write_partitions(log.where(F.lit(False)), path, "day")
    return read_back(spark, sf_dir, path)


@query("""
    SELECT 'events' AS table_name, CAST(ts AS DATE) AS day, COUNT(*) AS row_count
    FROM events GROUP BY 1, 2
    UNION ALL
    SELECT 'orders', CAST(o_orderdate AS DATE), COUNT(*) FROM orders GROUP BY 1, 2
    ORDER BY 1, 2
""")
def partition_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"events": events(spark, sf_dir), "orders": orders(spark, sf_dir)}
    return partitions.partition_row_counts(tables, "day")


@query("""
    SELECT DISTINCT 'events' AS table_name, CAST(ts AS DATE) AS day FROM events
    UNION ALL
    SELECT DISTINCT 'orders', CAST(o_orderdate AS DATE) FROM orders
""")
def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"events": events(spark, sf_dir), "orders": orders(spark, sf_dir)}
    return partitions.partition_inventory(tables, "day")


@query("""
    SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)),
                                       max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders
""")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.date_spine(orders(spark, sf_dir), "day")


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events ORDER BY day DESC LIMIT 7")
def recent_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitions.recent_partitions(events(spark, sf_dir), 7)


@query("""
    WITH present AS (
        SELECT DISTINCT o_orderpriority AS table_name, CAST(o_orderdate AS DATE) AS day FROM orders
    ), spine AS (
        SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM present
    )
    SELECT t.table_name, s.day FROM (SELECT DISTINCT table_name FROM present) t, spine s
    WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.table_name = t.table_name AND p.day = s.day)
""")
def missing_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without an order, per priority, over the whole period."""
    inventory = orders(spark, sf_dir).select(F.col("o_orderpriority").alias("table_name"), "day")
    first, last = order_span(spark, sf_dir)
    return partitions.missing_partitions(inventory.distinct(), last, (last - first).days + 1)


@query("""
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'F'
    EXCEPT
    SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'O'
""")
def unbuilt_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with finished but without open orders."""
    sales = orders(spark, sf_dir)
    finished = sales.where(F.col("o_orderstatus") == "F")
    return partitions.unbuilt_partitions(finished, sales.where(F.col("o_orderstatus") == "O"))


@query("""
    WITH candidates AS (
        SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') ORDER BY day DESC LIMIT 100
    )
    SELECT day FROM candidates WHERE day NOT IN (
        SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '5-LOW'
    )
""")
def due_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the last hundred days with an urgent or high order, those without a low one."""
    inventory = orders(spark, sf_dir).select(F.col("o_orderpriority").alias("table_name"), "day")
    candidates = partitions.days_of_any(inventory, ["1-URGENT", "2-HIGH"])
    return partitions.due_partitions(candidates, partitions.days_of_any(inventory, ["5-LOW"]), 100)


@query("""
    WITH days AS (
        SELECT CAST(o_orderdate AS DATE) AS day FROM orders
        GROUP BY 1 HAVING COUNT(DISTINCT o_orderpriority) = 5
    ), slow AS (
        SELECT l_returnflag, min(CAST(date_trunc('month', l_shipdate) + INTERVAL 1 MONTH AS DATE)) AS day
        FROM lineitem GROUP BY 1
    )
    SELECT day FROM days
    WHERE day >= (SELECT CASE WHEN COUNT(*) = 3 THEN max(day) END FROM slow)
""")
def partition_readiness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that hold all five priorities and are covered by all three monthly inputs."""
    exact = orders(spark, sf_dir).select(F.col("o_orderpriority").alias("table_name"), "day").distinct()
    month = F.add_months(F.trunc(F.to_date("l_shipdate"), "MM"), 1)
    slow = read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("table_name"), month.alias("day")
    )
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    return partitions.partition_readiness(exact, priorities, slow.distinct(), ["A", "N", "R"])


@query("""
    WITH checks AS (
        SELECT 'raw.events' AS table_name, max(ts) AS newest,
               TIMESTAMP '2024-01-30 09:00:00' AS oldest_allowed FROM events
        UNION ALL
        SELECT 'ml.events', max(ts), TIMESTAMP '2024-01-29 11:00:00' FROM events
        UNION ALL
        SELECT 'raw.orders', max(o_orderdate), TIMESTAMP '2023-12-05 09:00:00' FROM orders
        UNION ALL
        SELECT 'mart.lineitem', max(l_shipdate), TIMESTAMP '2024-01-30 10:00:00' FROM lineitem
    )
    SELECT *, CASE WHEN newest >= oldest_allowed THEN 'PASS' ELSE 'FAIL' END AS status FROM checks
""")
def freshness_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read(spark, sf_dir, "events")
    tables = {
        "raw.events": (log, "ts", partitions.LANDING_DAILY),
        "ml.events": (log, "ts", partitions.ML),
        "raw.orders": (read(spark, sf_dir, "orders"), "o_orderdate", partitions.LANDING_MONTHLY),
        "mart.lineitem": (read(spark, sf_dir, "lineitem"), "l_shipdate", partitions.MODELS),
    }
    return partitions.freshness_audit(tables, NOW)


@query("""
    WITH named AS (
        SELECT '/drop/' || CASE event_type WHEN 'click' THEN strftime(ts, 'sales_details_%Y_%m_%d.csv')
                    WHEN 'view' THEN strftime(ts, 'CUST_INFO_%Y_%m_%d.CSV')
                    WHEN 'purchase' THEN strftime(ts, 'loc_a101_%Y_%m_%d.txt')
                    WHEN 'signup' THEN strftime(ts, 'prd_info_%Y_%m.csv')
                    ELSE strftime(ts, 'refunds_%Y_%m_%d.csv') END AS path
        FROM events
    ), files AS (
        SELECT path, lower(regexp_extract(path, '[^/]*$')) AS name, COUNT(*) AS row_count
        FROM named GROUP BY 1, 2
    ), parts AS (
        SELECT *, regexp_extract(name, '^([a-z0-9_]+_)\\d{4}_\\d{2}_\\d{2}\\.csv$', 1) AS daily,
               regexp_extract(name, '^([a-z0-9_]+_)\\d{4}_\\d{2}\\.csv$', 1) AS monthly,
               replace(regexp_extract(name, '\\d{4}_\\d{2}(_\\d{2})?'), '_', '-') AS stamp
        FROM files
    )
    SELECT path, row_count,
           CASE WHEN monthly = 'prd_info_' THEN 'prd_info' ELSE rtrim(daily, '_') END AS source,
           CASE WHEN monthly = 'prd_info_' THEN 'monthly' ELSE 'daily' END AS cadence,
           CAST(CASE WHEN monthly = 'prd_info_' THEN stamp || '-01' ELSE stamp END AS DATE) AS partition_day
    FROM parts
    WHERE monthly = 'prd_info_' OR daily IN ('sales_details_', 'cust_info_', 'loc_a101_')
""")
def route_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names made from events: known daily and monthly ones, upper case, unknown ones."""
    patterns = {
        "click": "'sales_details_'yyyy_MM_dd'.csv'",
        "view": "'CUST_INFO_'yyyy_MM_dd'.CSV'",
        "purchase": "'loc_a101_'yyyy_MM_dd'.txt'",
        "signup": "'prd_info_'yyyy_MM'.csv'",
    }
    name = F.date_format("ts", "'refunds_'yyyy_MM_dd'.csv'")
    for event_type, pattern in patterns.items():
        name = F.when(F.col("event_type") == event_type, F.date_format("ts", pattern)).otherwise(name)
    path = F.concat(F.lit("/drop/"), name)
    files = events(spark, sf_dir).groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
    return routing.route_files(files, "path")


@query("""
    SELECT CAST(ts AS DATE) AS day, COUNT(*) AS row_count, COUNT(DISTINCT user_id) AS entities,
           AVG(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS flagged_rate,
           COUNT(*) FILTER (WHERE event_type = 'error') AS flagged_count
    FROM events GROUP BY 1
""")
def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.load_stats(events(spark, sf_dir), "day", "user_id", F.col("event_type") == "error")


@query("""
    SELECT 'customer' AS table_name, 'c_custkey' AS column_name, COUNT(*) - COUNT(c_custkey) AS failures
    FROM customer
    UNION ALL SELECT 'customer', 'c_name', COUNT(*) - COUNT(c_name) FROM customer
    UNION ALL SELECT 'customer', 'c_nationkey', COUNT(*) - COUNT(c_nationkey) FROM customer
    UNION ALL SELECT 'customer', 'c_acctbal', COUNT(*) - COUNT(c_acctbal) FROM customer
    UNION ALL SELECT 'customer', 'c_mktsegment', COUNT(*) - COUNT(NULLIF(c_mktsegment, 'BUILDING'))
              FROM customer
    UNION ALL SELECT 'orders', 'o_orderkey', COUNT(*) - COUNT(o_orderkey) FROM orders
    UNION ALL SELECT 'orders', 'o_custkey', COUNT(*) - COUNT(o_custkey) FROM orders
    UNION ALL SELECT 'orders', 'o_orderpriority', COUNT(*) - COUNT(NULLIF(o_orderpriority, '5-LOW'))
              FROM orders
""")
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column, with one value of a column turned into NULL in each table."""
    people = read(spark, sf_dir, "customer")
    people = people.withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    sales = read(spark, sf_dir, "orders")
    sales = sales.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    order_columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return (
        quality.null_counts(people)
        .select(F.lit("customer").alias("table_name"), "*")
        .unionByName(
            quality.null_counts(sales, order_columns).select(F.lit("orders").alias("table_name"), "*")
        )
    )


@query("""
    SELECT l_orderkey, l_linenumber, COUNT(*) AS row_count FROM lineitem
    GROUP BY 1, 2 HAVING COUNT(*) > 1
""")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_groups(read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    WITH results AS (
        SELECT 'orders' AS table_name, 'not_null' AS test, 'o_custkey' AS column_names,
               'error' AS severity, COUNT(*) - COUNT(o_custkey) AS failures FROM orders
        UNION ALL
        SELECT 'orders', 'unique_combination', 'o_orderkey', 'error', COUNT(*)
        FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING COUNT(*) > 1)
        UNION ALL
        SELECT 'orders', 'unique_combination', 'o_custkey,o_orderdate', 'warn', COUNT(*)
        FROM (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1)
        UNION ALL
        SELECT 'lineitem', 'not_null', 'l_partkey', 'warn', COUNT(*) - COUNT(l_partkey) FROM lineitem
        UNION ALL
        SELECT 'lineitem', 'unique_combination', 'l_orderkey,l_linenumber', 'error', COUNT(*)
        FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
    )
    SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail'
                   ELSE 'warn' END AS status
    FROM results
""")
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.audit_all(
        {
            "orders": (
                read(spark, sf_dir, "orders"),
                [
                    NotNull("o_custkey"),
                    UniqueCombination(("o_orderkey",)),
                    UniqueCombination(("o_custkey", "o_orderdate"), "warn"),
                ],
            ),
            "lineitem": (
                read(spark, sf_dir, "lineitem"),
                [NotNull("l_partkey", "warn"), UniqueCombination(("l_orderkey", "l_linenumber"))],
            ),
        }
    )


@query("""
    WITH counts AS (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS row_count
                    FROM orders GROUP BY 1)
    SELECT c.day, c.row_count, COALESCE(p.row_count, 0) AS previous_count,
           c.row_count / greatest(COALESCE(p.row_count, 0), 1) AS ratio,
           c.row_count / greatest(COALESCE(p.row_count, 0), 1) BETWEEN 0.8 AND 1.2 AS passed
    FROM counts c LEFT JOIN counts p ON p.day = c.day - 1
""")
def dq_rowcount_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rowcount_drift(orders(spark, sf_dir), "day")


@query("""
    SELECT CASE c_custkey % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS root, c_name AS "CID", c_mktsegment AS "CNTRY",
           DATE '2024-01-15' AS snapshot_date
    FROM customer
""")
def two_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written to two warehouses of one catalog, by whether their key is even, and read from both."""
    frames = []
    for remainder, root in enumerate(("even", "odd")):
        path = scratch_path(spark, f"root-{root}")
        store = Warehouse(spark, path, prefix=f"{root}_{path[-8:]}_")
        rows = read(spark, sf_dir, "customer").where(F.col("c_custkey") % 2 == remainder)
        rows = rows.select(
            F.col("c_name").alias("CID"), F.col("c_mktsegment").alias("CNTRY"), F.lit(EVENTS_AS_OF).alias("snapshot_date")
        )
        store.replace_partition("raw.loc_a101", rows, EVENTS_AS_OF)
        frames.append((root, store))
    tables = [store.table("raw.loc_a101").withColumn("root", F.lit(root)) for root, store in frames]
    return tables[0].unionByName(tables[1])


STALE_READS = {
    "target": {"daily": SAME_DAY, "monthly": NEWEST, "log": HISTORY},
    "report": {"target": SAME_DAY},
    "rolling": {"report": HISTORY},
}


@query("""
    WITH o AS (
        SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS k, o_orderkey % 997 = 0 AS late, o_orderpriority AS p, o_orderstatus AS s
        FROM orders
    ), v AS (
        SELECT 'daily' AS t, day, max(k) AS now, max(k) FILTER (NOT late) AS was FROM o GROUP BY day
        UNION ALL
        SELECT 'monthly', CAST(date_trunc('month', day) AS DATE), max(k), max(k) FILTER (NOT late) FROM o
        WHERE s = 'F' AND day(day) % 7 = 0 GROUP BY 2
        UNION ALL
        SELECT 'log', day, max(k), max(k) FILTER (NOT late) FROM o WHERE p = '1-URGENT' AND day > DATE '2001-07-10' GROUP BY day
    ), built AS (
        SELECT DISTINCT day FROM o WHERE p = '5-LOW'
    ), changed AS (
        SELECT b.day FROM built b
        WHERE (SELECT max(now) FROM v WHERE t = 'daily' AND v.day = b.day)
              IS DISTINCT FROM (SELECT max(was) FROM v WHERE t = 'daily' AND v.day = b.day)
           OR (SELECT arg_max(now, v.day) FROM v WHERE t = 'monthly' AND v.day <= b.day)
              IS DISTINCT FROM (SELECT arg_max(was, v.day) FROM v WHERE t = 'monthly' AND v.day <= b.day AND was IS NOT NULL)
           OR (SELECT max(now) FROM v WHERE t = 'log' AND v.day <= b.day)
              IS DISTINCT FROM (SELECT max(was) FROM v WHERE t = 'log' AND v.day <= b.day)
    )
    SELECT 'target' AS table_name, day, true AS changed FROM changed
    UNION ALL SELECT 'report', day, false FROM changed
    UNION ALL SELECT 'rolling', day, false FROM built WHERE day >= (SELECT min(day) FROM changed)
""")
def stale_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of three tables that late orders make stale: a day landed again, a month, a history that grew.

    Partitions have the greatest order key as their version; a table was built without every 997th order.
    """
    sales = orders(spark, sf_dir).select("day", "o_orderkey", "o_orderpriority", "o_orderstatus")

    def versions(rows: DataFrame) -> DataFrame:
        version = F.lpad(F.max("o_orderkey").cast("string"), 12, "0").alias("version")
        month = F.trunc("day", "month").alias("day")
        finished = rows.where("o_orderstatus = 'F' AND day(day) % 7 = 0").groupBy(month).agg(version)
        urgent = rows.where("o_orderpriority = '1-URGENT' AND day > DATE'2001-07-10'").groupBy("day").agg(version)
        parts = {"daily": rows.groupBy("day").agg(version), "monthly": finished, "log": urgent}
        return reduce(DataFrame.unionByName, [x.select(F.lit(t).alias("table_name"), "*") for t, x in parts.items()])

    days = sales.where("o_orderpriority = '5-LOW'").select("day").distinct()
    own = [days.select(F.lit(t).alias("table_name"), "day", F.lit("built").alias("version")) for t in STALE_READS]
    was = versions(sales.where("o_orderkey % 997 <> 0")).unionByName(reduce(DataFrame.unionByName, own))
    now = versions(sales).unionByName(reduce(DataFrame.unionByName, own))
    nothing = F.lit(None).cast("map<string, string>").alias("inputs")
    names = reduce(DataFrame.unionByName, own).select("table_name", "day")
    seen = partition_inputs(names.select("*", nothing), was, STALE_READS).where("current IS NOT NULL")
    entries = F.map_from_entries(F.collect_list(F.struct("input_name", "current"))).alias("inputs")
    noted = names.join(seen.groupBy("table_name", "day").agg(entries), ["table_name", "day"], "left")
    return stale_partitions(materialize(noted, "built"), materialize(now, "versions"), STALE_READS)
