"""As-of state, version histories, slow snapshots and surrogate keys."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import keys, latest, timeline
from tidemark.queries import query
from tidemark.queries.inputs import (
    EVENTS_AS_OF,
    ORDERS_AS_OF,
    cents,
    events,
    order_span,
    orders,
    read,
    span,
)
from tidemark.scratch import materialize, scratch_path
from tidemark.sinks.warehouse import write_partitions

LOG = "SELECT user_id, ts, event_id, event_type, value, CAST(ts AS DATE) AS day FROM events"


@query(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, day
                                     ORDER BY ts DESC, event_id DESC) AS rn
        FROM ({LOG})
    ) WHERE rn = 1
""")
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event of each user and day."""
    return latest.latest_per_key(events(spark, sf_dir), ["user_id", "day"], ["ts", "event_id"])


@query(f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
                                     ORDER BY day DESC, ts DESC, event_id DESC) AS rn
        FROM ({LOG}) WHERE day <= DATE '{EVENTS_AS_OF}'
    ) WHERE rn = 1
""")
def latest_per_key_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of each user on a day."""
    log = events(spark, sf_dir)
    return latest.latest_per_key_asof(log, ["user_id"], "day", EVENTS_AS_OF, ["ts", "event_id"])


@query(f"""
    WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT o.* FROM o
    WHERE day = (SELECT max(day) FROM o WHERE day <= DATE '{ORDERS_AS_OF}')
""")
def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the newest order day on or before a date."""
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "day")
    return latest.latest_partition(rows, "day", ORDERS_AS_OF)


@query(f"""
    WITH snapshots AS (
        SELECT CASE WHEN month(l_shipdate) <= 3 THEN make_date(year(l_shipdate), 1, 1)
                    ELSE make_date(year(l_shipdate), 4, 1) END AS effective_month, l_returnflag,
               COUNT(*) AS snapshot_lines,
               CAST(SUM(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS snapshot_cents
        FROM lineitem GROUP BY 1, 2
    ), days AS (
        SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders_of_day FROM orders GROUP BY 1
    ), effective AS (
        SELECT day, orders_of_day,
               (SELECT max(s.effective_month) FROM snapshots s WHERE s.effective_month <= day)
                   AS effective_month
        FROM days
    )
    SELECT e.day, e.orders_of_day, s.effective_month, s.l_returnflag, s.snapshot_lines,
           s.snapshot_cents
    FROM effective e JOIN snapshots s ON s.effective_month = e.effective_month
""")
def asof_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order day beside the irregular snapshot in effect that day.

    Two snapshots a year sum up the lines shipped in its first quarter and after it. They
    take effect on the first day of January and of April.
    """
    lines = read(spark, sf_dir, "lineitem")
    # By day first: calendar arithmetic then runs once per day and not once per line.
    by_day = lines.groupBy(F.to_date("l_shipdate").alias("shipped"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(cents("l_extendedprice")).alias("cents")
    )
    april = F.add_months(F.trunc("shipped", "year"), 3)
    month = F.least(F.trunc("shipped", "quarter"), april).alias("effective_month")
    snapshots = by_day.groupBy(month, "l_returnflag").agg(
        F.sum("lines").alias("snapshot_lines"), F.sum("cents").alias("snapshot_cents")
    )
    stored = materialize(snapshots, "snapshots")
    daily = timeline.bridge_to_days(stored, "effective_month", "day", *order_span(spark, sf_dir))
    days = orders(spark, sf_dir).groupBy("day").agg(F.count(F.lit(1)).alias("orders_of_day"))
    return days.join(daily, "day")


@query(f"""
    SELECT user_id, event_id, day,
           CAST(LEAD(day) OVER (PARTITION BY user_id ORDER BY day, ts, event_id)
                - INTERVAL 1 DAY AS DATE) AS end_date,
           LEAD(day) OVER (PARTITION BY user_id ORDER BY day, ts, event_id) IS NULL AS is_current
    FROM ({LOG})
""")
def scd2_close_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a version of its user, closed the day before the next one."""
    log = events(spark, sf_dir).select("user_id", "event_id", "day", "ts")
    closed = timeline.scd2_close_out(log, ["user_id"], "day", ["ts", "event_id"])
    return closed.drop("ts")


@query(f"""
    WITH versions AS (
        SELECT user_id, event_type, day, event_id,
               LEAD(day) OVER (PARTITION BY user_id, event_type ORDER BY day, event_id) AS next_day
        FROM ({LOG})
    )
    SELECT user_id, event_type, day, event_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY day DESC, event_id DESC) AS rn
        FROM versions WHERE next_day IS NULL
    ) WHERE rn = 1
""")
def current_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest of the current versions that each user has per event type."""
    log = events(spark, sf_dir).select("user_id", "day", "event_id", "event_type")
    closed = timeline.scd2_close_out(log, ["user_id", "event_type"], "day", ["event_id"])
    return latest.current_versions(closed, ["user_id"], "day").drop("end_date", "is_current")


@query(f"""
    WITH log AS ({LOG}), days AS (
        SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS snapshot_date FROM log
    ), newest AS (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, day
                                     ORDER BY ts DESC, event_id DESC) AS rn FROM log
    )
    SELECT user_id, snapshot_date, day AS changed_on, event_id, event_type, value FROM (
        SELECT n.*, d.snapshot_date,
               ROW_NUMBER() OVER (PARTITION BY n.user_id, d.snapshot_date ORDER BY n.day DESC) AS back
        FROM (SELECT * EXCLUDE (rn) FROM newest WHERE rn = 1) n
        JOIN days d ON n.day <= d.snapshot_date
    ) WHERE back = 1
""")
def backfill_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State of every user on every day."""
    log = events(spark, sf_dir)
    state = timeline.daily_state(
        log, ["user_id"], "day", *span(log), newest=["ts", "event_id"]
    )
    return state.select(
        "user_id", "snapshot_date", F.col("day").alias("changed_on"), "event_id", "event_type", "value"
    )


@query("""
    WITH o AS (
        SELECT CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_custkey END AS cust, o_orderkey
        FROM orders
    )
    SELECT ROW_NUMBER() OVER (ORDER BY cust NULLS LAST, o_orderkey) AS order_number, cust, o_orderkey
    FROM o
""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dense numbering by a key that is NULL in a fifth of the rows."""
    known = F.when(F.col("o_orderpriority") != "3-MEDIUM", F.col("o_custkey"))
    rows = orders(spark, sf_dir).select(known.alias("cust"), "o_orderkey")
    return keys.surrogate_key(rows, "order_number", ["cust", "o_orderkey"])


@query("""
    SELECT ROW_NUMBER() OVER (PARTITION BY o_orderstatus, CAST(o_orderdate AS DATE)
                              ORDER BY o_custkey, o_orderkey) AS order_number,
           o_orderstatus, CAST(o_orderdate AS DATE) AS day, o_custkey, o_orderkey
    FROM orders
""")
def surrogate_key_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbering that starts again in every group."""
    rows = orders(spark, sf_dir).select("o_orderstatus", "day", "o_custkey", "o_orderkey")
    return keys.surrogate_key(
        rows, "order_number", ["o_custkey", "o_orderkey"], within=["o_orderstatus", "day"]
    )


STATE_DAYS = EVENTS_AS_OF, EVENTS_AS_OF + dt.timedelta(days=2)


@query(f"""
    WITH days AS (
        SELECT CAST(d AS DATE) AS snapshot_date
        FROM generate_series(DATE '{STATE_DAYS[0]}', DATE '{STATE_DAYS[1]}', INTERVAL 1 DAY) t(d)
    )
    SELECT user_id, snapshot_date, day AS changed_on, event_id, event_type, value FROM (
        SELECT l.*, snapshot_date,
               ROW_NUMBER() OVER (PARTITION BY user_id, snapshot_date ORDER BY day DESC, ts DESC, event_id DESC) AS rn
        FROM ({LOG}) l JOIN days ON day <= snapshot_date
    ) WHERE rn = 1
""")
def state_from_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of three days from the stored state of the day before them and the changes of the three."""
    log = events(spark, sf_dir)
    eve = STATE_DAYS[0] - timeline.ONE_DAY
    path = scratch_path(spark, "states")
    before = timeline.daily_state(log, ["user_id"], "day", eve, eve, newest=["ts", "event_id"])
    write_partitions(before, path, "snapshot_date", many_days=False)
    states = spark.read.schema(before.schema).parquet(path)
    changes = timeline.state_from_previous(states, log, "day", *STATE_DAYS)
    state = timeline.daily_state(changes, ["user_id"], "day", *STATE_DAYS, newest=["ts", "event_id"])
    return state.select(
        "user_id", "snapshot_date", F.col("day").alias("changed_on"), "event_id", "event_type", "value"
    )
