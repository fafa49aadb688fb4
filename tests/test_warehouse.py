from __future__ import annotations

import datetime as dt
import os

import pytest

from tests.conftest import plan_of, tuples
from tidemark.operators.partitions import missing_partitions
from tidemark.schemas import LAYERS, TABLES, partition_column
from tidemark.sinks.warehouse import ForeignTable, Warehouse, replace_partition_at, write_partitions

D = [dt.date(2026, 4, d) for d in range(1, 10)]
SCHEMA = "k int, v string, day date"


@pytest.fixture
def warehouse(spark, tmp_path):
    """A warehouse whose tables are gone from the catalog afterwards; files stay."""
    store = Warehouse(spark, str(tmp_path / "warehouse"))
    yield store
    store.forget()


def stored(spark, path):
    return spark.read.schema(SCHEMA).parquet(path)


@pytest.fixture
def table(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    rows, days = write_partitions(frame([(1, "a", D[0]), (2, "b", D[1]), (3, "c", D[1])], SCHEMA), path, "day")
    assert (rows, days) == (3, (D[0], D[1]))
    return path


def test_replace_by_value_leaves_other_days(spark, frame, table):
    assert replace_partition_at(frame([(9, "z", D[1])], SCHEMA), table, "day", D[1]) == 1
    assert tuples(stored(spark, table)) == [(1, "a", D[0]), (9, "z", D[1])]


def test_replace_by_value_with_no_rows_clears_the_day(spark, frame, table):
    assert replace_partition_at(frame([], SCHEMA), table, "day", D[1]) == 0
    assert tuples(stored(spark, table)) == [(1, "a", D[0])]
    replace_partition_at(frame([(5, "n", D[1])], SCHEMA), table, "day", D[1])
    assert tuples(stored(spark, table)) == [(1, "a", D[0]), (5, "n", D[1])]


def test_replace_by_value_rejects_other_days(spark, frame, table):
    with pytest.raises(Exception, match="2026-04-01 in the file of 2026-04-02"):
        replace_partition_at(frame([(9, "z", D[0])], SCHEMA), table, "day", D[1])
    assert stored(spark, table).count() == 3, "a failed write leaves the table as it was"


def test_replace_present_with_no_rows_changes_nothing(spark, frame, table):
    assert write_partitions(frame([], SCHEMA), table, "day") == (0, ())
    assert stored(spark, table).count() == 3


def test_rerun_is_idempotent(spark, frame, table):
    before = tuples(stored(spark, table))
    for _ in range(2):
        write_partitions(frame([(2, "b", D[1]), (3, "c", D[1])], SCHEMA), table, "day")
    assert tuples(stored(spark, table)) == before


def test_many_days_are_rebalanced_and_one_day_is_not_shuffled(spark, frame, tmp_path):
    many = frame([(i, "x", D[i % 3]) for i in range(300)], SCHEMA).repartition(8)
    write_partitions(many, str(tmp_path / "many"), "day")
    files = stored(spark, str(tmp_path / "many")).inputFiles()
    assert len(files) == 3, "one file per small day, not one per task and day"


def test_tables_of_all_layers_are_created_once(warehouse):
    warehouse.create()
    warehouse.create()
    for name in TABLES:
        assert warehouse.spark.catalog.tableExists(name)
        assert warehouse.table(name).count() == 0
    assert {db.name for db in warehouse.spark.catalog.listDatabases()} >= set(LAYERS)


def test_catalog_table_is_replaced_by_name_and_pruned(warehouse, frame):
    rows = frame([(D[0], "US", "AW-1"), (D[1], "UK", "AW-2")], "snapshot_date date, CNTRY string, CID string")
    loaded = warehouse.replace_present("raw.loc_a101", rows)
    assert (loaded.rows, loaded.days) == (2, (D[0], D[1]))
    one = frame([("FR", "AW-3")], "CNTRY string, CID string").selectExpr("*", f"DATE'{D[1]}' AS snapshot_date")
    assert warehouse.replace_partition("raw.loc_a101", one, D[1]).rows == 1
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-1", "US", D[0]), ("AW-3", "FR", D[1])]
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan_of(
        warehouse.table("raw.loc_a101").where(f"snapshot_date = DATE'{D[1]}'")
    )
    cleared = warehouse.replace_partition("raw.loc_a101", one.where("false"), D[1])
    assert cleared.rows == 0
    assert tuples(warehouse.spark.sql("SELECT CID FROM raw.loc_a101")) == [("AW-1",)]


def test_a_new_session_finds_existing_partitions(warehouse, frame):
    rows = frame([("AW-1", "US", D[0])], "CID string, CNTRY string, snapshot_date date")
    warehouse.replace_present("raw.loc_a101", rows)
    warehouse.spark.sql("DROP TABLE raw.loc_a101")
    again = Warehouse(warehouse.spark, warehouse.root)
    again.create()
    assert tuples(again.table("raw.loc_a101")) == [("AW-1", "US", D[0])]


def test_static_table(warehouse, frame):
    rows = frame([("AC_BR", "Accessories", "Bike Racks", "Yes")], "ID string, CAT string, SUBCAT string, MAINTENANCE string")
    warehouse.replace_static("seeds.PX_CAT_G1V2", rows)
    warehouse.replace_static("seeds.PX_CAT_G1V2", rows)
    assert warehouse.table("seeds.PX_CAT_G1V2").count() == 1
    assert partition_column("seeds.PX_CAT_G1V2") is None


def test_two_roots_need_two_prefixes(warehouse, frame, tmp_path):
    schema = "CID string, CNTRY string, snapshot_date date"
    warehouse.replace_present("raw.loc_a101", frame([("AW-1", "US", D[0])], schema))
    same_names = Warehouse(warehouse.spark, str(tmp_path / "other"))
    with pytest.raises(ForeignTable, match="other"):
        same_names.replace_present("raw.loc_a101", frame([("AW-2", "UK", D[0])], schema))
    with pytest.raises(ForeignTable):
        same_names.table("raw.loc_a101")
    other = Warehouse(warehouse.spark, str(tmp_path / "other"), prefix="other_")
    other.replace_present("raw.loc_a101", frame([("AW-2", "UK", D[0])], schema))
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-1", "US", D[0])]
    assert tuples(other.table("raw.loc_a101")) == [("AW-2", "UK", D[0])]
    other.forget()
    assert not warehouse.spark.catalog.databaseExists("other_raw")
    assert tuples(warehouse.table("raw.loc_a101")) == [("AW-1", "US", D[0])]


def test_a_failed_load_leaves_the_static_table(warehouse, frame):
    schema = "ID string, CAT string, SUBCAT string, MAINTENANCE string"
    warehouse.replace_static("seeds.PX_CAT_G1V2", frame([("a", "b", "c", "d")], schema))
    broken = frame([("x", "b", "c", "d")], schema).selectExpr("raise_error('no') AS ID", "CAT", "SUBCAT", "MAINTENANCE")
    with pytest.raises(Exception, match="no"):
        warehouse.replace_static("seeds.PX_CAT_G1V2", broken)
    assert tuples(warehouse.table("seeds.PX_CAT_G1V2")) == [("a", "b", "c", "d")]


def test_inventory_comes_from_the_catalog(warehouse, frame):
    rows = frame([("AW-1", "US", D[0]), ("AW-2", "UK", D[2])], "CID string, CNTRY string, snapshot_date date")
    warehouse.replace_present("raw.loc_a101", rows)
    warehouse.create("raw.prd_info")
    inventory = warehouse.inventory("raw.loc_a101", "raw.prd_info")
    assert tuples(inventory) == [("raw.loc_a101", D[0]), ("raw.loc_a101", D[2])]
    assert "FileScan" not in plan_of(inventory)
    assert tuples(missing_partitions(inventory, D[2], 3)) == [("raw.loc_a101", D[1])]


def test_scratch_tables_are_discarded_after_use(spark, frame, tmp_path):
    from tidemark import scratch

    with scratch.discarding(spark):
        kept = scratch.materialize(frame([(1, "a", D[0])], SCHEMA), "t")
        files = kept.inputFiles()
        write_partitions(kept, str(tmp_path / "t"), "day")
        assert all(os.path.exists(f.removeprefix("file://")) for f in files)
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert stored(spark, str(tmp_path / "t")).count() == 1


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from tidemark import scratch

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master="yarn", applicationId="x"),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(cluster)
    cluster.conf.get = lambda name, default: "hdfs:///shared/"
    assert scratch.scratch_path(cluster, "keys").startswith("hdfs:///shared/tidemark/x/keys-")
