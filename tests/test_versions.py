"""Staged publishing, the version log and what follows from it."""

from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest

from tests.conftest import plan_of, tuples
from tidemark.operators import partitions
from tidemark.operators.quality import DataTestFailure
from tidemark.operators.staleness import levels, stale_partitions
from tidemark.plans import daily
from tidemark.sinks.versions import HISTORY, NEWEST, SAME_DAY, STATIC
from tidemark.sinks.warehouse import Warehouse

D = [dt.date(2026, 4, d) for d in range(1, 10)]
LOC = "raw.loc_a101"
SCHEMA = "CID string, CNTRY string, snapshot_date date"
SEED = "ID string, CAT string, SUBCAT string, MAINTENANCE string"


@pytest.fixture
def warehouse(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path / "warehouse"), prefix="versions_")
    yield store
    store.forget()


class Crash(RuntimeError):
    pass


def test_a_crash_between_the_steps_leaves_the_old_rows(warehouse, frame, monkeypatch):
    warehouse.replace_present(LOC, frame([("a", "US", D[0]), ("b", "US", D[1])], SCHEMA))
    warehouse.replace_static("seeds.PX_CAT_G1V2", frame([("x", "old", "s", "m")], SEED))

    def crash(*_):
        raise Crash

    with monkeypatch.context() as patch:
        patch.setattr(warehouse, "_point", crash)
        for attempt in (
            lambda: warehouse.replace_present(LOC, frame([("c", "UK", D[1]), ("d", "UK", D[2])], SCHEMA)),
            lambda: warehouse.replace_partition(LOC, frame([], SCHEMA), D[0]),
            lambda: warehouse.replace_static("seeds.PX_CAT_G1V2", frame([("x", "new", "s", "m")], SEED)),
        ):
            with pytest.raises(Crash):
                attempt()
    with monkeypatch.context() as patch:
        patch.setattr(warehouse.log, "append", crash)
        with pytest.raises(Crash):
            warehouse.replace_present(LOC, frame([("z", "ZZ", D[0])], SCHEMA))
    assert tuples(warehouse.table(LOC)) == [("a", "US", D[0]), ("b", "US", D[1])]
    assert [r.CAT for r in warehouse.table("seeds.PX_CAT_G1V2").collect()] == ["old"]
    # Whoever comes next may finish what was entered in the log.
    again = Warehouse(warehouse.spark, warehouse.root, prefix="versions_")
    again.settle(LOC, "seeds.PX_CAT_G1V2")
    assert tuples(again.table(LOC)) == [("c", "UK", D[1]), ("d", "UK", D[2])]
    assert [r.CAT for r in again.table("seeds.PX_CAT_G1V2").collect()] == ["new"]


def test_a_running_reader_keeps_its_rows_until_the_vacuum(warehouse, frame):
    warehouse.replace_present(LOC, frame([("a", "US", D[0]), ("b", "US", D[1])], SCHEMA))
    reading = warehouse.table(LOC).where(f"snapshot_date = DATE'{D[0]}'")
    reading._jdf.queryExecution().executedPlan()  # files are chosen now
    warehouse.replace_partition(LOC, frame([("n", "UK", D[0])], SCHEMA), D[0])
    assert tuples(reading) == [("a", "US", D[0])]
    assert warehouse.vacuum() == 0, "what was replaced a moment ago stays"
    assert warehouse.vacuum(dt.timedelta(0)) == 1
    assert tuples(warehouse.table(LOC)) == [("b", "US", D[1]), ("n", "UK", D[0])]
    assert warehouse.vacuum(dt.timedelta(0)) == 1, "deleting twice does no harm"


def test_another_catalog_shows_the_published_versions(warehouse, frame):
    warehouse.replace_present(LOC, frame([("a", "US", D[0]), ("b", "US", D[1])], SCHEMA))
    warehouse.replace_partition(LOC, frame([("n", "UK", D[0])], SCHEMA), D[0])
    warehouse.replace_static("seeds.PX_CAT_G1V2", frame([("x", "new", "s", "m")], SEED))
    warehouse.forget()
    other = Warehouse(warehouse.spark, warehouse.root, prefix="versions_")
    other.create()
    assert tuples(other.table(LOC)) == [("b", "US", D[1]), ("n", "UK", D[0])]
    assert other.table("seeds.PX_CAT_G1V2").count() == 1


def test_statistics_are_kept_and_no_data_file_is_opened(warehouse, frame):
    rows = [("a", "US", D[0]), ("b", None, D[0]), (None, None, D[1])]
    warehouse.replace_present(LOC, frame(rows, SCHEMA))
    warehouse.replace_partition(LOC, frame([], SCHEMA), D[2])
    found = warehouse.statistics(LOC)
    assert tuples(found.select("day", "row_count", "nulls.CID", "nulls.CNTRY")) == [
        (D[0], 2, 0, 1), (D[1], 1, 1, 1), (D[2], 0, 0, 0)
    ]
    now = dt.datetime.now() + dt.timedelta(days=3)
    fresh = daily.freshness(warehouse, now)
    for frame_of in (found, fresh):
        assert "parquet" not in plan_of(frame_of).lower()
    assert {r.table_name: r.status for r in fresh.collect()}[LOC] == "FAIL"
    soon = partitions.freshness_of_loads(found, {LOC: partitions.LANDING_DAILY}, dt.datetime(2026, 1, 1))
    assert [r.status for r in soon.collect()] == ["PASS"]


def test_only_tested_rows_are_published(warehouse, frame):
    name, schema = "staging.stg_erp_LOC_A101", "CID string, CNTRY string, dwh_create_date timestamp, snapshot_date date"
    good = frame([("a", "US", None, D[0]), ("b", "US", None, D[1])], schema)
    daily.publish_tested(warehouse, name, lambda: good)
    for bad, test in (
        ([("a", "UK", None, D[0]), ("a", "FR", None, D[0])], "unique_combination"),
        ([(None, "UK", None, D[0])], r"not_null\(CID\) 1"),
        ([("a", "UK", None, D[0]), ("c", "UK", None, None)], r"not_null\(snapshot_date\) 1"),
    ):
        with pytest.raises(DataTestFailure, match=test) as failure:
            daily.publish_tested(warehouse, name, lambda: frame(bad, schema))
        assert warehouse.staged_rows(failure.value.staged).count() == len(bad)
    assert tuples(warehouse.table(name).drop("dwh_create_date")) == [("a", "US", D[0]), ("b", "US", D[1])]


READS = {
    "one": {"daily": SAME_DAY, "monthly": NEWEST, "log": HISTORY, "seed": STATIC},
    "two": {"one": SAME_DAY},
    "three": {"two": HISTORY, "monthly": NEWEST},
}


def brute(built, versions, reads):
    held = {}
    for name, day, version in versions:
        held.setdefault(name, {})[day] = version
    stale, changed = set(), set()
    for name in reads:  # inputs first
        for built_name, day, inputs in built:
            if built_name != name:
                continue
            for i, kind in reads[name].items():
                days = sorted(d for d in held.get(i, {}) if d is not None and d <= day)
                if kind == STATIC:
                    now, uses = held.get(i, {}).get(None), []
                elif kind == SAME_DAY:
                    now, uses = held.get(i, {}).get(day), [day]
                elif kind == NEWEST:
                    now, uses = (held[i][days[-1]], days[-1:]) if days else (None, [])
                else:
                    now, uses = max((held[i][d] for d in days), default=None), days
                if now != inputs.get(i):
                    changed.add((name, day))
                if now != inputs.get(i) or any((i, d) in stale for d in uses):
                    stale.add((name, day))
    return sorted((n, d, (n, d) in changed) for n, d in stale)


@pytest.mark.parametrize("seed", range(3))
def test_stale_partitions_against_plain_code(spark, frame, seed):
    draw = random.Random(seed)
    names = ["daily", "monthly", "log"]
    versions = [(n, d, f"v{draw.randrange(30):02d}") for n in names for d in D if draw.random() < (0.3 if n == "monthly" else 0.8)]
    versions += [("seed", None, "v05")]
    built = []
    for name, day in itertools.product(READS, D):
        if draw.random() < 0.85:
            versions.append((name, day, f"b{draw.randrange(3)}"))
    held = {(n, d): v for n, d, v in versions}
    for name, day in itertools.product(READS, D):
        if (name, day) in held:
            inputs = {}
            for i, kind in READS[name].items():
                days = [d for n, d in held if n == i and d is not None and d <= day]
                keys = {STATIC: [None], SAME_DAY: [day], NEWEST: days and [max(days)], HISTORY: days}[kind]
                seen = [held[i, d] for d in keys if (i, d) in held]
                if seen and draw.random() < 0.95:
                    inputs[i] = max(seen) if draw.random() < 0.95 else "v99"
            built.append((name, day, inputs))
    found = stale_partitions(
        frame(built, "table_name string, day date, inputs map<string, string>"),
        frame(versions, "table_name string, day date, version string"),
        READS,
    )
    assert levels(READS) == 3
    assert sorted(map(tuple, found.collect())) == brute(built, versions, READS)
