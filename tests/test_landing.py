from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tests.conftest import plan_of, tuples
from tests.files import write_csv
from tidemark.schemas import table_schema
from tidemark.sources import landing, routing

DAY = dt.date(2026, 4, 27)
MONTH = dt.date(2026, 4, 1)


def test_file_names():
    assert landing.snapshot_file("sales_details", DAY) == "sales_details_2026_04_27.csv"
    assert landing.snapshot_file("prd_info", MONTH) == "prd_info_2026_04.csv"
    with pytest.raises(KeyError):
        landing.snapshot_file("refunds", DAY)


def test_daily_file_has_declared_types_and_text_dates(spark, tmp_path):
    rows = [("SO1", "BK-R93R-62", 11000, "20101229", "0", None, 3578, 1, 3578)]
    write_csv(tmp_path, "sales_details_2026_04_27.csv", "sales_details", rows, ("snapshot_date", DAY))
    df = landing.read_snapshot(spark, str(tmp_path), "sales_details", DAY)
    assert [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in table_schema("raw.sales_details")
    ]
    assert tuples(df) == [("SO1", "BK-R93R-62", 11000, "20101229", "0", None, 3578, 1, 3578, DAY)]


def test_absent_partition_column_is_filled_from_the_name(spark, tmp_path):
    write_csv(tmp_path, "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")])
    assert tuples(landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)) == [("AW-1", "US", DAY)]


def test_partition_column_with_time_is_normalised(spark, tmp_path):
    write_csv(tmp_path, "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")], ("snapshot_date", f"{DAY} 00:00:00"))
    assert tuples(landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)) == [("AW-1", "US", DAY)]


def test_monthly_file_accepts_both_date_forms_and_crlf(spark, tmp_path):
    rows = [
        (210, "CO-RF-FR-R92B-58", "HL", None, "R ", "2003-07-01", None),
        (211, "CO-RF-FR-R92B-58", "HL", 12, "", "2012-07-01 00:00:00", "2007-12-28"),
    ]
    write_csv(tmp_path, "prd_info_2026_04.csv", "prd_info", rows, ("snapshot_month", MONTH), newline="\r\n")
    found = tuples(landing.read_snapshot(spark, str(tmp_path), "prd_info", MONTH))
    assert [r[5] for r in found] == [dt.date(2003, 7, 1), dt.date(2012, 7, 1)]
    assert {r[-1] for r in found} == {MONTH}


def test_columns_are_matched_by_name(spark, tmp_path):
    (tmp_path / "loc_a101_2026_04_27.csv").write_text("CNTRY,CID\nUS,AW-1\n")
    assert tuples(landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)) == [("AW-1", "US", DAY)]


def test_unknown_or_missing_columns_are_rejected(spark, tmp_path):
    (tmp_path / "loc_a101_2026_04_27.csv").write_text("CID,COUNTRY\nAW-1,US\n")
    with pytest.raises(ValueError, match="unknown .*COUNTRY.* missing .*CNTRY"):
        landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)


def test_rows_of_another_day_are_rejected(spark, tmp_path):
    write_csv(tmp_path, "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")], ("snapshot_date", MONTH))
    with pytest.raises(PySparkException, match="snapshot_date 2026-04-01 in the file of 2026-04-27"):
        landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY).collect()


def test_malformed_number_fails(spark, tmp_path):
    write_csv(tmp_path, "cust_info_2026_04_27.csv", "cust_info", [("x1", "AW1", "a", "b", "S", "F", "2025-01-01")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_snapshot(spark, str(tmp_path), "cust_info", DAY).collect()


def test_missing_markers_and_whole_numbers_with_a_fraction(spark, tmp_path):
    rows = [
        ("1.0", "NULL", "n/a", "x", "S", "<NA>", "2025-01-01"), ("nan", "k", "Nan", "y", None, "F", "None"),
        ("2e3", "k", "a", "b", "S", "F", "null"),
    ]
    write_csv(tmp_path, "cust_info_2026_04_27.csv", "cust_info", rows)
    found = tuples(landing.read_snapshot(spark, str(tmp_path), "cust_info", DAY))
    day = dt.date(2025, 1, 1)
    assert found == [
        (None, "k", "Nan", "y", None, "F", None, DAY), (1, None, None, "x", "S", None, day, DAY),
        (2000, "k", "a", "b", "S", "F", None, DAY),
    ]


def test_a_fraction_fails(spark, tmp_path):
    write_csv(tmp_path, "cust_info_2026_04_27.csv", "cust_info", [("1.5", "AW1", "a", "b", "S", "F", "2025-01-01")])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        landing.read_snapshot(spark, str(tmp_path), "cust_info", DAY).collect()


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "loc_a101_2026_04_27.csv").write_text('CID,CNTRY\nAW-1,"United\n""States"""\n')
    found = landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY, multi_line=True)
    assert tuples(found) == [("AW-1", 'United\n"States"', DAY)]


def test_headers_are_read_without_a_job(spark, tmp_path):
    paths = []
    for i in range(60):
        day = DAY + dt.timedelta(days=i)
        paths.append(write_csv(tmp_path, f"loc_a101_{day:%Y_%m_%d}.csv", "loc_a101", [(f"AW-{i}", "US")]))
    group = "headers"
    spark.sparkContext.setJobGroup(group, group)
    df = landing.read_snapshots(spark, "loc_a101", paths)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert jobs <= 1 and df.count() == 60


def test_names_are_routed_once_per_file_and_not_per_row(spark, tmp_path):
    write_csv(tmp_path, "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")] * 3)
    df = landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)
    of_rows, of_files = plan_of(df).split("BroadcastExchange", 1)
    assert "FileScan csv" in of_rows and "regexp_extract" not in of_rows and "try_to" not in of_rows
    assert "FileScan csv" not in of_files
    assert tuples(df) == [("AW-1", "US", DAY)] * 3


def test_plain_whole_numbers_are_not_cast_by_trial(spark, tmp_path):
    texts = {"7": 7, "-7.0": -7, "+7.": 7, "-0.00": 0, "007": 7, " 7": 7, "999999999.0": 999999999,
             "2147483647.0": 2147483647, "-2147483648": -2147483648, "7e1": 70, ".7e1": 7}
    rows = [(text, f"AW{i:02}", "a", "b", "S", "F", "2025-01-01") for i, text in enumerate(texts)]
    write_csv(tmp_path, "cust_info_2026_04_27.csv", "cust_info", rows)
    df = landing.read_snapshot(spark, str(tmp_path), "cust_info", DAY)
    found = {r.cst_key: r.cst_id for r in df.collect()}
    assert [found[k] for k in sorted(found)] == list(texts.values())
    assert "RLIKE" in plan_of(df).upper()


def test_missing_file_names_the_partition(spark, tmp_path):
    with pytest.raises(landing.MissingSnapshot, match="2026-04-27 of loc_a101"):
        landing.read_snapshot(spark, str(tmp_path), "loc_a101", DAY)


def test_several_files_with_different_headers(spark, tmp_path):
    other = DAY + dt.timedelta(days=1)
    a = write_csv(tmp_path, "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")])
    b = write_csv(tmp_path, "loc_a101_2026_04_28.csv", "loc_a101", [("AW-2", "UK")], ("snapshot_date", other))
    assert tuples(landing.read_snapshots(spark, "loc_a101", [a, b])) == [("AW-1", "US", DAY), ("AW-2", "UK", other)]


def test_seed(spark, tmp_path):
    path = write_csv(tmp_path, "PX_CAT_G1V2.csv", "PX_CAT_G1V2", [("AC_BR", "Accessories", "Bike Racks", "Yes")], newline="\r\n")
    assert tuples(landing.read_seed(spark, path, "seeds.PX_CAT_G1V2")) == [("AC_BR", "Accessories", "Bike Racks", "Yes")]


def test_route_files(frame):
    names = [
        "sales_details_2026_04_27.csv",
        "CUST_INFO_2026_04_28.CSV",
        "file:/drop/loc_a101_2026_04_29.csv",
        "prd_info_2026_04.csv",
        "prd_info_2026_04_27.csv",  # a monthly source with a daily name
        "sales_details_2026_04.csv",  # a daily source with a monthly name
        "refunds_2026_04_27.csv",
        "sales_details_2026_04_27.txt",
        "sales_details_2026_13_41.csv",
        "notes.csv",
    ]
    routed = routing.route_files(frame([(n,) for n in names], "name string"), "name")
    assert {(r.name, r.source, r.cadence, r.partition_day) for r in routed.collect()} == {
        (names[0], "sales_details", "daily", DAY),
        (names[1], "cust_info", "daily", dt.date(2026, 4, 28)),
        (names[2], "loc_a101", "daily", dt.date(2026, 4, 29)),
        (names[3], "prd_info", "monthly", MONTH),
    }
