from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tests.files import write_csv
from tidemark.sinks.warehouse import Warehouse
from tidemark.streaming import arrivals
from tidemark.streaming.ledger import Ledger

DAY = dt.date(2026, 4, 27)
NEXT = dt.date(2026, 4, 28)


@pytest.fixture
def warehouse(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "warehouse"), prefix="arrivals_")
    yield store
    store.forget()


def run(warehouse, tmp_path):
    query = arrivals.ingest(warehouse, str(tmp_path / "drop"), str(tmp_path / "checkpoint"))
    query.awaitTermination()


def test_new_files_are_landed_once(warehouse, tmp_path):
    drop = tmp_path / "drop"
    write_csv(drop, "LOC_A101_2026_04_27.CSV", "loc_a101", [("AW-1", "US")])
    write_csv(drop, "prd_info_2026_04.csv", "prd_info", [(1, "CO-RF-X", "n", 1, "R", "2003-07-01", None)])
    write_csv(drop, "refunds_2026_04_27.csv", "loc_a101", [("AW-9", "US")])
    (drop / "notes.txt").write_text("nothing")
    run(warehouse, tmp_path)
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-1", "US", DAY)]
    assert warehouse.table("raw.prd_info").count() == 1

    # The second run sees only the new file; a later one of the same stream adds its day.
    write_csv(drop, "loc_a101_2026_04_28.csv", "loc_a101", [("AW-2", "UK")])
    run(warehouse, tmp_path)
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-1", "US", DAY), ("AW-2", "UK", NEXT)]


def test_newest_file_of_a_partition_wins_and_an_empty_one_clears(spark, warehouse, tmp_path):
    drop = tmp_path / "drop"
    old = write_csv(drop / "a", "loc_a101_2026_04_27.csv", "loc_a101", [("AW-1", "US")])
    new = write_csv(drop / "b", "loc_a101_2026_04_27.csv", "loc_a101", [("AW-2", "UK")])
    os.utime(old, (1_700_000_000, 1_700_000_000))
    os.utime(new, (1_700_000_100, 1_700_000_100))
    files = spark.read.format("binaryFile").load([old, new]).select("path", "modificationTime")
    arrivals.land_files(warehouse, files)
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-2", "UK", DAY)]

    empty = write_csv(drop / "c", "loc_a101_2026_04_27.csv", "loc_a101", [])
    files = spark.read.format("binaryFile").load(empty).select("path", "modificationTime")
    assert [s.rows for s in arrivals.land_files(warehouse, files)] == [0, 0]
    assert warehouse.table("raw.loc_a101").count() == 0


def test_changed_files_are_landed_in_batches_in_the_order_of_their_times(warehouse, tmp_path):
    drop, ledger = tmp_path / "drop", str(tmp_path / "ledger")
    for i in range(5):
        path = write_csv(drop / str(i), "loc_a101_2026_04_27.csv", "loc_a101", [(f"AW-{i}", "US")])
        os.utime(path, (1_700_000_000 - i, 1_700_000_000 - i))  # the first is the newest
    stats = arrivals.ingest_changes(warehouse, f"{drop}/*", ledger, files_per_batch=2)
    assert len(stats) == 3
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-0", "US", DAY)]
    assert arrivals.ingest_changes(warehouse, f"{drop}/*", ledger) == []

    path = write_csv(drop / "3", "loc_a101_2026_04_27.csv", "loc_a101", [("AW-9", "UK")])
    os.utime(path, (1_700_000_100, 1_700_000_100))
    after = dt.datetime.fromtimestamp(1_700_000_050, dt.timezone.utc)
    assert arrivals.ingest_changes(warehouse, f"{drop}/*", ledger, since=after + dt.timedelta(days=1)) == []
    assert len(arrivals.ingest_changes(warehouse, f"{drop}/*", ledger, since=after)) == 1
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-9", "UK", DAY)]
    assert arrivals.ingest_changes(warehouse, f"{drop}/*", ledger) == []


def listed(spark, n):
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    return spark.range(n).select(F.format_string("f%06d.csv", "id").alias("path"), at.alias("modificationTime"))


def test_one_new_file_among_a_hundred_thousand(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    assert ledger.fresh(listed(spark, 3)).count() == 3
    ledger.add(listed(spark, 100_000))
    changed = listed(spark, 100_001).withColumn(
        "modificationTime", F.expr("modificationTime + make_dt_interval(if(path = 'f000007.csv', 1, 0))")
    )
    assert tuples(ledger.fresh(changed).select("path")) == [("f000007.csv",), ("f100000.csv",)]


def test_ledger_is_compacted_and_forgets_removed_files(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    for n in (4, 5, 6):
        ledger.add(listed(spark, n))
    assert not ledger.compact(after=3) and ledger.steps() == (0, [1, 2, 3])
    assert ledger.compact(listed(spark, 10).where("path <> 'f000002.csv'"), after=2)
    assert ledger.steps() == (3, []) and os.listdir(tmp_path / "ledger") == ["full-3"]
    assert ledger.rows().count() == 5
    ledger.add(listed(spark, 3))
    assert ledger.steps() == (3, [4])
    assert tuples(ledger.fresh(listed(spark, 7)).select("path")) == [("f000006.csv",)]
    # What an interrupted compaction left behind is not read.
    listed(spark, 7).write.parquet(str(tmp_path / "ledger" / "new-2"))
    assert ledger.rows().count() == 6
