"""Three days of files through landing, staging, marts, reports and models."""

from __future__ import annotations

import datetime as dt

import pytest

from tests.conftest import tuples
from tests.files import write_csv
from tidemark.operators.quality import DataTestFailure
from tidemark.plans import daily, reporting, staging
from tidemark.schemas import TABLES
from tidemark.sinks.warehouse import Warehouse

D1, D2, D3 = dt.date(2026, 4, 1), dt.date(2026, 4, 2), dt.date(2026, 4, 3)
MAY = dt.date(2026, 5, 1)
TODAY = dt.date(2026, 4, 3)

CUSTOMERS = {
    D1: [
        (1, "AW00000001", " Ann ", " Lee", "S", " f", "2025-01-01"),
        (2, "AW00000002", "Bob", "Ray", "m ", "x", "2025-01-02"),
        (3, "AW00000003", "Cy", "Old", "x", "M", "2025-01-01"),
        (3, "AW00000003", "Cy", "New", None, "M", "2025-02-01"),
        (None, "AW00000008", "No", "Id", "S", "F", "2025-01-01"),
        (None, "AW00000009", "No", "Id2", "S", "F", "2025-01-05"),
    ],
    # Customer 2 changes, customer 4 is created and changed on the same day.
    D2: [
        (2, "AW00000002", "Bob", "Ray", "S", "x", "2025-01-02"),
        (4, "AW00000004", "Di", "A", "S", "F", "2026-04-02"),
        (4, "AW00000004", "Di", "B", "S", "F", "2026-04-02"),
    ],
    D3: [],
}
LOCATIONS = {
    D1: [("AW-00000001", "US"), ("AW-00000002", " DE"), ("AW-00000003", "")],
    D2: [("AW-00000001", "UK"), ("AW-00000004", "null")],
    D3: [],
}
SALES = {
    D1: [
        ("SO1", "HL-U509-R", 1, 20260301, 20260303, 20260310, 20, 2, 10),
        ("SO1", "HL-U509-R", 1, 20260301, 0, None, None, 1, -10),
        ("SO2", "BK-X", 2, 5489, 20260304, 20260311, 7, 2, None),
        ("SO3", "UNKNOWN", 3, 20260320, 20260322, 20260330, 5, 1, 5),
        ("SO4", "HL-U509-R", 99, 20260320, 20260322, 20260330, 5, 1, 5),
        ("SO5", "HL-U509-R", None, 20260320, 20260322, 20260330, 0, 0, 5),
    ],
    D2: [
        ("SO6", "HL-U509-R", 1, 20251101, 20260303, 20260310, 20, 2, 10),
        ("SO7", "BK-X", 4, 20260401, 20260403, 20260408, 9, 1, 0),
        ("SO8", "BK-X", 2, 20251001, 20251003, 20251008, 8, 1, 8),
        ("SO9", "BK-X", 3, 20260215, 20260303, 20260308, 8, 1, 8),
    ],
    D3: [("SO10", "HL-U509-R", 2, 20260402, 20260404, 20260409, 10, 1, 10)],
}
PRODUCTS = {
    D1: [
        (10, "AC-HE-HL-U509-R", "Helmet", 12, "S ", "2011-07-01", "2007-12-28"),
        (11, "AC-HE-HL-U509-R", "Helmet", 14, "S ", "2012-07-01", "2008-12-27"),
        (12, "AC-HE-HL-U509-R", "Helmet", 13, "S ", "2013-07-01", None),
        (13, "CO-PE-BK-X", "Pedal", None, "", "2013-07-01", None),
    ],
    MAY: [(13, "CO-PE-BK-X", "Pedal", 3, "R", "2013-07-01 00:00:00", None)],
}
ERP = [
    ("NASAW00000001", "1971-10-06", "Male"),
    ("AW00000002", "2099-01-01", " female "),
    ("AW00000003", "1980-01-01", ""),
    ("AW0000001", "1980-01-01", "M"),
]
TAXONOMY = [("AC_HE", " Accessories", "Helmets ", "Yes"), ("CO_PD", "Components", "Pedals", "No")]


def land_day(warehouse, folder, day, locations=None):
    stamp = ("snapshot_date", day)
    write_csv(folder, f"cust_info_{day:%Y_%m_%d}.csv", "cust_info", CUSTOMERS[day], stamp)
    write_csv(folder, f"loc_a101_{day:%Y_%m_%d}.csv", "loc_a101", locations or LOCATIONS[day], stamp)
    write_csv(folder, f"sales_details_{day:%Y_%m_%d}.csv", "sales_details", SALES[day], stamp)
    for source in ("cust_info", "loc_a101", "sales_details"):
        daily.land(warehouse, str(folder), source, day)


def land_products(warehouse, folder, month):
    write_csv(folder, f"prd_info_{month:%Y_%m}.csv", "prd_info", PRODUCTS[month], ("snapshot_month", month))
    daily.land(warehouse, str(folder), "prd_info", month)


PREPARED: list[Warehouse] = []


def prepare(spark, folder):
    warehouse = Warehouse(spark, str(folder / "warehouse"), prefix=f"daily{len(PREPARED)}_")
    PREPARED.append(warehouse)
    seeds = folder / "seeds"
    daily.load_seed(warehouse, write_csv(seeds, "CUST_AZ12.csv", "CUST_AZ12", ERP), "seeds.CUST_AZ12")
    daily.load_seed(warehouse, write_csv(seeds, "PX_CAT_G1V2.csv", "PX_CAT_G1V2", TAXONOMY), "seeds.PX_CAT_G1V2")
    return warehouse


def forget(spark):
    while PREPARED:
        PREPARED.pop().forget()


def content(warehouse, names=TABLES):
    return {name: tuples(warehouse.table(name).drop("dwh_create_date")) for name in names}


def rows_of(warehouse, name, day, *columns):
    return tuples(warehouse.table(name).where(f"snapshot_date = DATE'{day}'").select(*columns))


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All three days built by one range build; the tables are also kept as Python values."""
    folder = tmp_path_factory.mktemp("range")
    forget(spark)
    warehouse = prepare(spark, folder)
    for day in (D1, D2, D3):
        land_day(warehouse, folder, day)
    land_products(warehouse, folder, D1)
    result = daily.build(warehouse, D1, D3, today=TODAY)
    yield warehouse, result, folder
    forget(spark)


def test_customers_carry_forward(built):
    warehouse, _, _ = built
    columns = ("customer_key", "customer_id", "last_name", "country", "marital_status", "gender", "birth_date")
    born = dt.date(1971, 10, 6)
    first = [
        (1, 1, "Lee", "United States", "Single", "Female", born),
        (2, 2, "Ray", "Germany", "Married", "Female", None),
        (3, 3, "New", "N/A", "N/A", "Male", dt.date(1980, 1, 1)),
        (4, None, "Id2", None, "Single", "Female", None),
    ]
    second = [
        (1, 1, "Lee", "United Kingdom", "Single", "Female", born),
        (2, 2, "Ray", "Germany", "Single", "Female", None),
        first[2],
        (4, 4, "B", "N/A", "Single", "Female", None),
        (5, None, "Id2", None, "Single", "Female", None),
    ]
    assert rows_of(warehouse, "mart.dim_customers", D1, *columns) == first
    assert rows_of(warehouse, "mart.dim_customers", D2, *columns) == second
    assert rows_of(warehouse, "mart.dim_customers", D3, *columns) == second


def test_products_history_and_current(built):
    warehouse, _, _ = built
    columns = (
        "product_key", "product_id", "product_number", "product_line", "category", "cost", "start_date",
        "end_date", "is_current",
    )
    y = [dt.date(2011 + i, 7, 1) for i in range(3)]
    history = [
        (1, 10, "HL_U509_R", "Other Sales", "Accessories", 12, y[0], dt.date(2012, 6, 30), False),
        (2, 11, "HL_U509_R", "Other Sales", "Accessories", 14, y[1], dt.date(2013, 6, 30), False),
        (3, 13, "BK_X", "N/A", None, 0, y[2], None, True),
        (4, 12, "HL_U509_R", "Other Sales", "Accessories", 13, y[2], None, True),
    ]
    for day in (D1, D2, D3):
        assert rows_of(warehouse, "mart.dim_products_history", day, *columns) == history
        assert rows_of(warehouse, "mart.dim_products", day, *columns) == history[2:]


def test_staged_products_exist_on_month_starts_only(built):
    warehouse, _, _ = built
    assert tuples(warehouse.table("staging.stg_crm_prd_info").select("snapshot_date").distinct()) == [(D1,)]


def test_facts_keep_unmatched_lines(built):
    warehouse, _, _ = built
    columns = (
        "order_number", "product_key", "customer_key", "order_date", "shipping_date", "due_date",
        "sales_amount", "quantity", "sls_price",
    )
    march = lambda d: dt.date(2026, 3, d)
    expected = [
        ("SO1", 4, 1, march(1), None, None, 10, 1, 10.0),
        ("SO1", 4, 1, march(1), march(3), march(10), 20, 2, 10.0),
        ("SO2", 3, 2, None, march(4), march(11), 7, 2, 3.5),
        ("SO3", None, 3, march(20), march(22), march(30), 5, 1, 5.0),
        ("SO4", 4, None, march(20), march(22), march(30), 5, 1, 5.0),
        ("SO5", 4, None, march(20), march(22), march(30), 0, 0, 5.0),
    ]
    assert rows_of(warehouse, "mart.fct_sales", D1, *columns) == expected


def test_reports(built):
    warehouse, _, _ = built
    customer = rows_of(
        warehouse, "reporting.rpt_sales_summary_by_customer", D1, "customer_id", "total_orders", "total_sales",
        "total_quantity_sold", "avg_order_value", "first_order_date", "days_since_first_order",
    )
    first = dt.date(2026, 3, 1)
    assert customer == [
        (1, 2, 30, 3, 15.0, first, 0), (2, 1, 7, 2, 7.0, None, None), (3, 1, 5, 1, 5.0, dt.date(2026, 3, 20), 0)
    ]
    product = rows_of(
        warehouse, "reporting.rpt_sales_performance_by_product", D1, "product_number", "total_orders",
        "total_sales", "total_quantity_sold", "avg_unit_price", "total_cost", "total_profit",
    )
    assert product == [("BK_X", 1, 7, 2, 3.5, 0, 7), ("HL_U509_R", 4, 35, 4, 7.5, 52, -17)]


def test_features_drop_customers_without_order_date(built):
    warehouse, _, _ = built
    columns = ("customer_id", "recency_days", "frequency", "monetary", "features_as_of_date")
    assert rows_of(warehouse, "ml_features.customer_rfm", D1, *columns) == [
        (1, 31, 2, 30.0, D1), (3, 12, 1, 5.0, D1)
    ]


def test_declared_tests_ran_and_warnings_are_kept(built):
    _, result, _ = built
    assert len(result.tests) == 50
    assert {(t.table_name, t.column_names) for t in result.tests if t.status != "pass"} == {
        ("raw.cust_info", "cst_id"),
        ("staging.stg_crm_cust_info", "cst_id"),
        ("staging.stg_erp_CUST_AZ12", "CID"),
        ("mart.dim_customers", "customer_id"),
    }


def test_rebuild_of_one_day_changes_nothing(built):
    warehouse, _, _ = built
    before = content(warehouse)
    daily.build(warehouse, D2, today=TODAY)
    assert content(warehouse) == before


def test_readme_queries_run_on_the_catalog(built):
    warehouse, _, _ = built
    top = warehouse.spark.sql(
        "SELECT first_name, last_name, country, total_orders, total_sales "
        f"FROM {warehouse.prefix}reporting.rpt_sales_summary_by_customer ORDER BY total_sales DESC LIMIT 10"
    )
    assert top.first().total_sales == 30
    day = warehouse.table("reporting.rpt_sales_summary_by_customer").where(f"snapshot_date = DATE'{D1}'")
    assert [r.first_name for r in reporting.top_customers(day, 2).collect()] == ["Ann", "Bob"]


def test_training_writes_day_by_day_and_guards_keep_results(built):
    warehouse, _, _ = built
    assert [s.table for s in daily.train(warehouse, D1)] == ["ml_features.customer_segments"], (
        "all recencies are below the threshold, so there is no churn model"
    )
    stats = [s.table for s in daily.train(warehouse, D2)]
    assert stats == ["ml_features.customer_segments", "ml_features.churn_predictions"]
    before = content(warehouse, ["ml_features.customer_segments", "ml_features.churn_predictions"])
    assert daily.train(warehouse, dt.date(2026, 4, 20)) == []
    assert content(warehouse, before) == before
    assert tuples(daily.ml_stats(warehouse).select("snapshot_date", "rows")) == [(D1, 2), (D2, 4)]
    report = reporting.high_risk_customers(
        warehouse.table("ml_features.churn_predictions"),
        warehouse.table("ml_features.customer_segments"),
        warehouse.table("ml_features.customer_rfm"),
        D2,
    )
    assert {r.first_name for r in report.collect()} <= {"Ann", "Bob", "Cy", "Di"}
    assert report.columns[:5] == ["first_name", "last_name", "country", "segment_label", "churn_prob"]
    from pyspark.ml import PipelineModel

    assert len(PipelineModel.load(daily.churn_model_path(warehouse, D2)).stages) == 3


def test_day_by_day_equals_range_and_new_month_supersedes(spark, built, tmp_path_factory):
    range_content = content(built[0], [n for n in TABLES if not n.endswith(("segments", "predictions"))])
    forget(spark)
    folder = tmp_path_factory.mktemp("days")
    warehouse = prepare(spark, folder)
    for day in (D1, D2, D3):
        land_day(warehouse, folder, day)
        if day == D2:  # the month file arrives late
            land_products(warehouse, folder, D1)
            daily.build(warehouse, D1, today=TODAY)
        if day != D1:
            daily.build(warehouse, day, today=TODAY)
    assert content(warehouse, range_content) == range_content

    land_products(warehouse, folder, MAY)
    for source, header in (("cust_info", ()), ("loc_a101", ()), ("sales_details", ())):
        write_csv(folder, f"{source}_{MAY:%Y_%m_%d}.csv", source, header)
        daily.land(warehouse, str(folder), source, MAY)
    daily.build(warehouse, MAY, today=MAY)
    products = rows_of(warehouse, "mart.dim_products", MAY, "product_id", "product_line", "cost")
    assert products == [(13, "Road", 3)], "the newest monthly snapshot is the whole product list"
    assert content(warehouse, ["mart.fct_sales"])["mart.fct_sales"] == range_content["mart.fct_sales"]
    assert len(rows_of(warehouse, "mart.dim_customers", MAY, "customer_key")) == 5


def test_landed_again_days_become_stale_and_are_built_from_the_day_before(spark, tmp_path):
    forget(spark)
    warehouse = prepare(spark, tmp_path)
    for day in (D1, D2, D3):
        land_day(warehouse, tmp_path, day)
    land_products(warehouse, tmp_path, D1)
    daily.build(warehouse, D1, D3, today=TODAY)
    assert daily.stale(warehouse).count() == 0 and daily.pending(warehouse, D3).count() == 0

    def state_scan(day):
        changes = daily.marts.location_changes(warehouse.table("staging.stg_erp_LOC_A101"))
        return daily._state(warehouse, "state.locations", changes, daily.marts.location_state, day, day)

    # A daily build reads the state of the day before and the changes of the day.
    files = state_scan(D2).inputFiles()
    assert {f.split("snapshot_date=")[1][:10] for f in files} == {str(D1), str(D2)} and len(files) == 2
    assert sum("/state/locations/" in f for f in files) == 1

    again = [("AW-00000001", "FR"), ("AW-00000004", "DE")]
    land_day(warehouse, tmp_path, D2, locations=again)
    found = {(r.table_name, r.day): r.changed for r in daily.stale(warehouse).collect()}
    staged = ["stg_crm_cust_info", "stg_crm_sales_details", "stg_erp_LOC_A101"]
    assert {k for k, changed in found.items() if changed} == {(f"staging.{n}", D2) for n in staged}
    later = {n for n, d in found if d == D3}
    assert later == {
        "state.customers", "state.locations", "mart.dim_customers", "reporting.rpt_sales_summary_by_customer",
        "reporting.rpt_sales_performance_by_product", "mart.fct_sales", "ml_features.customer_rfm",
    }
    assert not any(d == D1 for _, d in found)
    assert tuples(daily.pending(warehouse, D3)) == [(D2, False, "stale"), (D3, False, "stale")]

    # Day 3 alone: its state may not start from that of day 2, which is stale.
    daily.build(warehouse, D2, D3, today=TODAY)
    assert daily.stale(warehouse).count() == 0
    places = rows_of(warehouse, "mart.dim_customers", D3, "customer_id", "country")
    assert places[1:] == [(1, "France"), (2, "Germany"), (3, "N/A"), (4, "Germany")]
    land_day(warehouse, tmp_path, D1, locations=[("AW-00000002", "US")])
    daily.build(warehouse, D1, today=TODAY)
    assert {f.split("/warehouse/")[1].split("/")[0] for f in state_scan(D3).inputFiles()} == {"staging"}
    places = tuples(state_scan(D3).select("CID", "CNTRY"))
    assert places == [("AW00000001", "France"), ("AW00000002", "United States"), ("AW00000004", "Germany")]

    land_products(warehouse, tmp_path, D1)  # the month again: every day that uses it
    found = {(r.table_name, r.day) for r in daily.stale(warehouse).collect()}
    assert {d for n, d in found if n == "mart.dim_products_history"} == {D1, D2, D3}
    assert ("staging.stg_crm_prd_info", D1) in found
    assert daily._product_days(warehouse, D2, D3) == [D1]
    forget(spark)


def test_monthly_files_with_changes_only(frame):
    rows = [
        (1, "AC-HE-X", "old", 1, "R", dt.date(2011, 7, 1), D1), (2, "AC-HE-Y", "kept", 2, "M", dt.date(2011, 7, 1), D1),
        (1, "AC-HE-X", "new", 9, "R", dt.date(2011, 7, 1), MAY), (3, "AC-HE-Y", "next", 3, "M", dt.date(2012, 7, 1), MAY),
    ]
    raw = frame(rows, "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, prd_start_dt date, snapshot_month date")
    eve = MAY - dt.timedelta(days=1)
    carried = staging.crm_prd_info(raw, eve, MAY, changes_only=True)
    assert tuples(carried.select("snapshot_date", "prd_id", "prd_nm", "prd_end_dt")) == [
        (eve, 1, "old", None), (eve, 2, "kept", None),
        (MAY, 1, "new", None), (MAY, 2, "kept", dt.date(2012, 6, 30)), (MAY, 3, "next", None),
    ]
    full = staging.crm_prd_info(raw, eve, MAY)
    assert tuples(full.select("snapshot_date", "prd_id")) == [(eve, 1), (eve, 2), (MAY, 1), (MAY, 3)]


def test_known_months_are_not_looked_up_in_the_data(spark, frame):
    rows = [(1, "AC-HE-X", "a", 1, "R", dt.date(2011, 7, 1), D1), (2, "AC-HE-Y", "b", 2, "M", dt.date(2011, 7, 1), MAY)]
    raw = frame(rows, "prd_id int, prd_key string, prd_nm string, prd_cost int, prd_line string, prd_start_dt date, snapshot_month date")
    spark.sparkContext.setJobGroup("known-months", "")
    given = staging.crm_prd_info(raw, D2, MAY, known=[D1, MAY])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("known-months")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert tuples(given.drop("dwh_create_date")) == tuples(staging.crm_prd_info(raw, D2, MAY).drop("dwh_create_date"))


def test_a_cleared_month_does_not_supersede(spark, tmp_path):
    forget(spark)
    warehouse = prepare(spark, tmp_path)
    land_products(warehouse, tmp_path, D1)
    land_products(warehouse, tmp_path, MAY)
    assert warehouse.filled_days("raw.prd_info") == [D1, MAY]
    warehouse.replace_partition("raw.prd_info", warehouse.table("raw.prd_info").limit(0), MAY)
    assert warehouse.filled_days("raw.prd_info") == [D1]
    forget(spark)


def test_failed_test_stops_the_build(spark, tmp_path):
    forget(spark)
    warehouse = prepare(spark, tmp_path)
    land_day(warehouse, tmp_path, D1, locations=[("AW-00000001", "US"), ("AW00000001", "UK")])
    with pytest.raises(DataTestFailure, match="stg_erp_LOC_A101: unique_combination") as failure:
        daily.build(warehouse, D1, today=TODAY)
    assert warehouse.staged_rows(failure.value.staged).count() == 2, "what was written stays for inspection"
    assert warehouse.table("staging.stg_erp_LOC_A101").count() == 0, "and is not published"
    assert warehouse.table("mart.dim_customers").count() == 0
    forget(spark)


def test_no_monthly_snapshot_yet(spark, tmp_path):
    forget(spark)
    warehouse = prepare(spark, tmp_path)
    land_day(warehouse, tmp_path, D1)
    daily.build(warehouse, D1, today=TODAY)
    assert warehouse.table("mart.dim_products_history").count() == 0
    assert {r[0] for r in rows_of(warehouse, "mart.fct_sales", D1, "product_key")} == {None}
    forget(spark)
