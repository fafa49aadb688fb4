"""Land files, build the tables of a day or a range of days, test what was written, then publish it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.partitions import (
    LANDING_DAILY,
    LANDING_MONTHLY,
    ML,
    MODELS,
    Freshness,
    freshness_of_loads,
    partition_readiness,
    unbuilt_partitions,
)
from tidemark.operators.quality import DataTest, DataTestFailure, NotNull, audit, enforce, not_null_results, require
from tidemark.operators.staleness import stale_partitions
from tidemark.operators.timeline import ONE_DAY, state_from_previous
from tidemark.plans import marts, ml, reporting, staging
from tidemark.plans.declared_tests import DECLARED
from tidemark.plans.staging import MONTH, SNAPSHOT, in_days
from tidemark.schemas import RAW_TABLES, TABLES, partition_column
from tidemark.scratch import discarding
from tidemark.sinks.versions import HISTORY, NEWEST, SAME_DAY, STATIC
from tidemark.sinks.warehouse import LoadStats, Staged, Warehouse
from tidemark.sources.landing import read_seed, read_snapshot


@dataclass
class BuildResult:
    """What one build wrote, and the outcome of every declared test."""

    loads: list[LoadStats] = field(default_factory=list)
    tests: list = field(default_factory=list)


def land(
    warehouse: Warehouse, folder: str, source: str, day: dt.date, multi_line: bool = False
) -> LoadStats:
    """Replace one partition of a raw table by its file."""
    rows = read_snapshot(warehouse.spark, folder, source, day, multi_line)
    return warehouse.replace_partition(f"raw.{source}", rows, day)


def load_seed(warehouse: Warehouse, path: str, table: str) -> None:
    warehouse.replace_static(table, read_seed(warehouse.spark, path, table))


def tested(warehouse: Warehouse, staged: Staged, tests: Sequence[DataTest] | None = None) -> list:
    """Run a table's declared tests on what is staged; a failed error-level test raises.

    NULLs were counted when the rows were written; other tests read the staged files. Rows that
    failed stay where they are staged: the error names the folder, ``staged`` has them.
    """
    declared = DECLARED.get(staged.table, []) if tests is None else tests
    not_null = [t for t in declared if isinstance(t, NotNull)]
    others = [t for t in declared if not isinstance(t, NotNull)]
    results = not_null_results(staged.table, not_null, staged.null_counts())
    if others:
        results += audit(warehouse.staged_rows(staged), staged.table, others).collect()
    try:
        return require(results)
    except DataTestFailure as failure:
        raise DataTestFailure(f"{failure}; the rows are in {staged.path}", staged) from None


def publish_tested(
    warehouse: Warehouse,
    name: str,
    rows: Callable[[], DataFrame],
    many_days: bool = True,
    result: BuildResult | None = None,
) -> LoadStats:
    """Write, test, publish: the table changes only if no test of severity ``error`` failed.

    ``rows`` makes the rows; the versions of the inputs are noted before it is called.
    """
    inputs = warehouse.log.noted(READS.get(name, {}))
    staged = warehouse.stage(name, rows(), many_days=many_days)
    results = tested(warehouse, staged)
    load = warehouse.publish(staged, inputs)
    if result is not None:
        result.tests += results
        result.loads.append(load)
    return load


def _test(warehouse: Warehouse, name: str, start: dt.date, end: dt.date, result: BuildResult) -> None:
    """Test the partitions just built; a failed error-level test stops the build here."""
    if name not in DECLARED:
        return
    rows = in_days(warehouse.table(name), start, end, partition_column(name))
    result.tests += enforce(audit(rows, name, DECLARED[name]))


def _current(warehouse: Warehouse, name: str, day: dt.date) -> bool:
    """Whether a partition is built, and from the versions that its inputs have now."""
    built = warehouse.log.of(name).get(day)
    return built is not None and built.inputs == warehouse.log.noted(READS[name])(day)


def _product_days(w: Warehouse, start: dt.date, end: dt.date) -> list[dt.date]:
    """Days on which staged products are due: month snapshots in range, never staged, or landed again since."""
    landed = [d for d in w.days("raw.prd_info") if d <= end]
    return [d for d in landed if d >= start or not _current(w, "staging.stg_crm_prd_info", d)]


# How each table finds the partitions of its inputs.
READS: dict[str, dict[str, str]] = {
    "staging.stg_crm_cust_info": {"raw.cust_info": SAME_DAY},
    "staging.stg_crm_prd_info": {"raw.prd_info": NEWEST},
    "staging.stg_crm_sales_details": {"raw.sales_details": SAME_DAY},
    "staging.stg_erp_CUST_AZ12": {"seeds.CUST_AZ12": STATIC},
    "staging.stg_erp_LOC_A101": {"raw.loc_a101": SAME_DAY},
    "staging.stg_erp_PX_CAT_G1V2": {"seeds.PX_CAT_G1V2": STATIC},
    "state.customers": {"staging.stg_crm_cust_info": HISTORY},
    "state.locations": {"staging.stg_erp_LOC_A101": HISTORY},
    "mart.dim_customers": {
        "state.customers": SAME_DAY,
        "state.locations": SAME_DAY,
        "staging.stg_erp_CUST_AZ12": SAME_DAY,
    },
    "mart.dim_products_history": {
        "staging.stg_crm_prd_info": NEWEST,
        "staging.stg_erp_PX_CAT_G1V2": SAME_DAY,
    },
    "mart.dim_products": {"mart.dim_products_history": SAME_DAY},
    "mart.fct_sales": {
        "staging.stg_crm_sales_details": SAME_DAY,
        "mart.dim_products": SAME_DAY,
        "mart.dim_customers": SAME_DAY,
    },
    "reporting.rpt_sales_summary_by_customer": {"mart.fct_sales": SAME_DAY, "mart.dim_customers": SAME_DAY},
    "reporting.rpt_sales_performance_by_product": {"mart.fct_sales": SAME_DAY, "mart.dim_products": SAME_DAY},
    "ml_features.customer_rfm": {"reporting.rpt_sales_summary_by_customer": SAME_DAY},
}


def _state(
    warehouse: Warehouse,
    name: str,
    changes: DataFrame,
    advance: Callable[[DataFrame, dt.date, dt.date], DataFrame],
    start: dt.date,
    end: dt.date,
) -> DataFrame:
    """States of the days from the state of the day before and the days' changes.

    Where the day before is missing, or any partition that its state was made from has been
    added or replaced since, the whole log is read instead.
    """
    if _current(warehouse, name, start - ONE_DAY):
        changes = state_from_previous(warehouse.table(name), changes, "changed_on", start, end)
    return advance(changes, start, end)


Builder = Callable[[Warehouse, dt.date, dt.date, dt.date | None], DataFrame]

# Build order: a table only reads tables above it.
DAILY_TABLES: dict[str, Builder] = {
    "staging.stg_crm_cust_info": lambda w, a, b, _: staging.crm_cust_info(
        w.table("raw.cust_info"), a, b
    ),
    "staging.stg_crm_sales_details": lambda w, a, b, _: staging.crm_sales_details(
        w.table("raw.sales_details"), a, b
    ),
    "staging.stg_erp_CUST_AZ12": lambda w, a, b, today: staging.erp_cust_az12(
        w.table("seeds.CUST_AZ12"), a, b, today
    ),
    "staging.stg_erp_LOC_A101": lambda w, a, b, _: staging.erp_loc_a101(
        w.table("raw.loc_a101"), a, b
    ),
    "staging.stg_erp_PX_CAT_G1V2": lambda w, a, b, _: staging.erp_px_cat(
        w.table("seeds.PX_CAT_G1V2"), a, b
    ),
    "state.customers": lambda w, a, b, _: _state(
        w, "state.customers", marts.customer_changes(w.table("staging.stg_crm_cust_info")), marts.customer_state, a, b
    ),
    "state.locations": lambda w, a, b, _: _state(
        w, "state.locations", marts.location_changes(w.table("staging.stg_erp_LOC_A101")), marts.location_state, a, b
    ),
    "mart.dim_customers": lambda w, a, b, _: marts.dim_customers_of(
        w.table("state.customers"), w.table("staging.stg_erp_CUST_AZ12"), w.table("state.locations"), a, b
    ),
    "mart.dim_products_history": lambda w, a, b, _: marts.dim_products_history(
        w.table("staging.stg_crm_prd_info"),
        w.table("staging.stg_erp_PX_CAT_G1V2"),
        a,
        b,
        known=w.filled_days("staging.stg_crm_prd_info"),
    ),
    "mart.dim_products": lambda w, a, b, _: marts.dim_products(
        w.table("mart.dim_products_history"), a, b
    ),
    "mart.fct_sales": lambda w, a, b, _: marts.fct_sales(
        w.table("staging.stg_crm_sales_details"),
        w.table("mart.dim_products"),
        w.table("mart.dim_customers"),
        a,
        b,
    ),
    "reporting.rpt_sales_summary_by_customer": lambda w, a, b, _: (
        reporting.sales_summary_by_customer(w.table("mart.fct_sales"), w.table("mart.dim_customers"), a, b)
    ),
    "reporting.rpt_sales_performance_by_product": lambda w, a, b, _: (
        reporting.sales_performance_by_product(w.table("mart.fct_sales"), w.table("mart.dim_products"), a, b)
    ),
    "ml_features.customer_rfm": lambda w, a, b, _: reporting.customer_rfm(
        w.table("reporting.rpt_sales_summary_by_customer"), a, b
    ),
}


# Tables of one step do not read each other and are built side by side.
STEPS: tuple[tuple[str, ...], ...] = (
    tuple(name for name in DAILY_TABLES if name.startswith("staging.")),
    ("state.customers", "state.locations", "mart.dim_products_history"),
    ("mart.dim_customers", "mart.dim_products"),
    ("mart.fct_sales",),
    tuple(name for name in DAILY_TABLES if name.startswith("reporting.")),
    ("ml_features.customer_rfm",),
)


def _stage_products(
    warehouse: Warehouse, start: dt.date, end: dt.date, result: BuildResult
) -> None:
    """Stage the products of the months that are due, on the first day of each."""
    days = _product_days(warehouse, start, end)
    if not days:
        return
    name, first, last = "staging.stg_crm_prd_info", days[0], days[-1]

    def rows() -> DataFrame:
        months = warehouse.filled_days("raw.prd_info")
        products = staging.crm_prd_info(warehouse.table("raw.prd_info"), first, last, known=months)
        return products.where(F.col(SNAPSHOT).isin(days))

    publish_tested(warehouse, name, rows, first != last, result)


def _side_by_side(warehouse: Warehouse, tasks: list[Callable[[], None]]) -> None:
    """Run the jobs of independent tables together; the first failure is raised at the end."""
    share = inheritable_thread_target(warehouse.spark)
    with ThreadPool(len(tasks)) as pool:
        pool.map(share(lambda task: task()), tasks)


def build(
    warehouse: Warehouse, start: dt.date, end: dt.date | None = None, today: dt.date | None = None
) -> BuildResult:
    """Build every SQL table for the days ``start..end``, one job per table.

    Each table is written, tested, and published if no test failed; tables below a failed test are
    not built, and the failed table still shows its old rows. Days in range are replaced, all
    others stay as they are.
    """
    last = end or start
    result = BuildResult()
    warehouse.log.reload()
    warehouse.create()

    def test_raw() -> None:
        for name in RAW_TABLES:
            _test(warehouse, name, start, last, result)

    def table(name: str) -> None:
        with discarding(warehouse.spark):
            rows = partial(DAILY_TABLES[name], warehouse, start, last, today)
            publish_tested(warehouse, name, rows, start != last, result)

    sources = [test_raw, lambda: _stage_products(warehouse, start, last, result)]
    for step in STEPS:
        _side_by_side(warehouse, sources + [partial(table, name) for name in step])
        sources = []
    return result


def _outside(as_of: dt.date, lookback: int | None) -> Column:
    """Whether ``day`` is more than ``lookback`` days back."""
    return F.col("day") < F.lit(as_of - dt.timedelta(days=lookback - 1)) if lookback else F.lit(False)


def due(warehouse: Warehouse, as_of: dt.date, lookback: int | None = None) -> DataFrame:
    """Days that can be built and are not: ``day`` and ``outside``.

    A day can be built when all daily sources hold it and the product list holds some month on or
    before it. It is built when the last report holds it. Days after ``as_of`` are not due.
    ``outside`` marks those more than ``lookback`` days back, which a caller may leave for a
    backfill; without a lookback none is. Everything comes from the catalog.
    """
    sources = ["raw.sales_details", "raw.cust_info", "raw.loc_a101"]
    last = "reporting.rpt_sales_performance_by_product"
    warehouse.create(*sources, "raw.prd_info", last)
    ready = partition_readiness(
        warehouse.inventory(*sources), sources, warehouse.inventory("raw.prd_info"), ["raw.prd_info"]
    )
    open_days = unbuilt_partitions(ready.where(F.col("day") <= F.lit(as_of)), warehouse.inventory(last))
    return open_days.withColumn("outside", _outside(as_of, lookback))


def stale(warehouse: Warehouse) -> DataFrame:
    """``table_name, day, changed``: built partitions that would be made from other inputs now.

    A day that was landed again, a month that came late or a day added to the history makes
    everything built from it stale, up to the reports. From the version log alone.
    """
    warehouse.log.reload()
    newest = warehouse.log.newest()
    built = newest.where(F.col("day").isNotNull() & F.col("table_name").isin(*READS))
    return stale_partitions(
        built.select("table_name", "day", "inputs"), newest.select("table_name", "day", "version"), READS
    )


def pending(warehouse: Warehouse, as_of: dt.date, lookback: int | None = None) -> DataFrame:
    """``day, outside, reason``: days to build up to ``as_of``, ``missing`` as by ``due``, or ``stale``."""
    missing = due(warehouse, as_of, lookback).withColumn("reason", F.lit("missing"))
    changed = stale(warehouse).where(F.col("day") <= F.lit(as_of)).select("day").distinct()
    changed = changed.join(missing.select("day"), "day", "left_anti")
    changed = changed.select("day", _outside(as_of, lookback).alias("outside"), F.lit("stale").alias("reason"))
    return missing.unionByName(changed)


def _deadline(name: str) -> Freshness | None:
    """The freshness rule of a table's layer; static tables have none."""
    column = partition_column(name)
    if column is None:
        return None
    if name.startswith("raw."):
        return LANDING_MONTHLY if column == MONTH else LANDING_DAILY
    return ML if name.startswith("ml_features.") else MODELS


def freshness(warehouse: Warehouse, now: dt.datetime) -> DataFrame:
    """When each table was last published, against its deadline; from the version log alone."""
    rules = {name: rule for name in TABLES if (rule := _deadline(name)) is not None}
    return freshness_of_loads(warehouse.statistics(), rules, now)


def train(warehouse: Warehouse, day: dt.date) -> list[LoadStats]:
    """Segment and score the customers of one day; keep the fitted churn model per day.

    Nothing is written, and earlier results stay, when there is nothing to learn from.
    """
    warehouse.create()
    rfm = in_days(warehouse.table("ml_features.customer_rfm"), day, day)
    keep = ["customer_key", "customer_id", SNAPSHOT]
    loads = []
    segments = ml.customer_segments(rfm, keep)
    if segments is not None:
        loads.append(warehouse.replace_partition("ml_features.customer_segments", segments, day))
    scored = ml.churn_predictions(rfm, keep)
    if scored is not None:
        predictions, model = scored
        loads.append(warehouse.replace_partition("ml_features.churn_predictions", predictions, day))
        model.write().overwrite().save(churn_model_path(warehouse, day))
    return loads


def churn_model_path(warehouse: Warehouse, day: dt.date) -> str:
    return f"{warehouse.root}/artifacts/churn_model/{SNAPSHOT}={day.isoformat()}"


def ml_stats(warehouse: Warehouse) -> DataFrame:
    """Rows, clusters, positive rate and high-risk customers of every trained day."""
    segments = warehouse.table("ml_features.customer_segments")
    churn = warehouse.table("ml_features.churn_predictions")
    clusters = segments.groupBy(SNAPSHOT, "segment_id").agg(F.count(F.lit(1)).alias("members"))
    per_day = clusters.groupBy(SNAPSHOT).agg(
        F.sum("members").alias("rows"), F.count(F.lit(1)).alias("clusters")
    )
    risk = churn.groupBy(SNAPSHOT).agg(
        F.avg(F.col("is_high_risk").cast("int")).alias("high_risk_rate"),
        F.count_if("is_high_risk").alias("high_risk_count"),
    )
    return per_day.join(risk, SNAPSHOT, "full")
