"""Layered tables whose partitions are replaced as a whole.

Two write semantics, never mixed:

* ``replace_partition``: the named partition ends up holding exactly the given rows; no
  rows clear it.
* ``replace_present``: the partitions found in the given rows are replaced; no rows leave
  the table as it is.

A warehouse's tables are written in two steps. ``stage`` writes the rows to a folder of their own, which no
reader knows. ``publish`` enters the new versions in a log and then points the catalog at them,
one partition at a time: a reader sees the old rows or the new ones, and a crash in between
leaves the old ones. What was staged can be tested before it is published. Replaced versions
stay until ``vacuum``, so that running readers finish.

The functions on paths, for tables outside a catalog, stage their files and swap whole
partition directories on commit.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.files import delete_folder, exists, make_folder, qualified, swap_folder
from tidemark.schemas import LAYERS, TABLES, partition_column, table_schema
from tidemark.sinks.versions import Published, VersionLog, new_version
from tidemark.sources.landing import require_partition


@dataclass(frozen=True)
class LoadStats:
    table: str
    rows: int
    days: tuple[dt.date, ...]


def write_partitions(
    df: DataFrame, path: str, day: str, many_days: bool = True
) -> tuple[int, tuple[dt.date, ...]]:
    """Replace the partitions present in ``df`` below ``path``; returns rows and days written.

    With ``many_days`` the rows are first rebalanced by day: a large day is split over
    several tasks, a small one is not scattered over all of them. Rows of one day are
    written from where they are, without a shuffle.
    """
    written = Observation()
    placed = df.hint("rebalance", day) if many_days else df
    # Days are observed on the way to the files: one entry per partition at most.
    observed = placed.observe(
        written, F.count(F.lit(1)).alias("rows"), F.collect_set(day).alias("days")
    )
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(day)
        .parquet(path)
    )
    result = written.get
    return result["rows"], tuple(sorted(result["days"]))


def write_beside(df: DataFrame, target: str, root: str) -> None:
    """Write ``df`` to a hidden folder next to ``root`` and put it in the place of ``target``."""
    parent, _, name = root.rstrip("/").rpartition("/")
    staged = f"{parent}/_staged-{name}-{uuid.uuid4().hex}"
    df.write.parquet(staged)
    swap_folder(df.sparkSession, staged, target)


def clear_partition(spark: SparkSession, path: str, day: str, value: dt.date, schema) -> None:
    """Leave the partition in place without rows."""
    columns = [c for c in schema.names if c != day]
    empty = spark.createDataFrame([], schema).select(*columns)
    write_beside(empty, f"{path}/{day}={value.isoformat()}", path)


def replace_partition_at(df: DataFrame, path: str, day: str, value: dt.date) -> int:
    """Make the partition ``value`` below ``path`` hold exactly ``df``; returns its rows."""
    checked = require_partition(df, day, F.lit(value))
    rows, _ = write_partitions(checked, path, day, many_days=False)
    if rows == 0:
        clear_partition(df.sparkSession, path, day, value, df.schema)
    return rows


@dataclass(frozen=True)
class Staged:
    """Rows of one table that are written and not yet published; counts by partition."""

    table: str
    version: str
    path: str
    row_counts: Mapping[dt.date | None, int] = field(default_factory=dict)
    nulls: Mapping[dt.date | None, Mapping[str, int]] = field(default_factory=dict)

    @property
    def rows(self) -> int:
        return sum(self.row_counts.values())

    @property
    def days(self) -> tuple[dt.date, ...]:
        return tuple(sorted(d for d in self.row_counts if d is not None))

    def null_counts(self) -> dict[str, int]:
        """NULLs by column, over all partitions."""
        total: dict[str, int] = {}
        for counts in self.nulls.values():
            for column, n in counts.items():
                total[column] = total.get(column, 0) + n
        return total


# Spark formats the dates of a description with a formatter that threads must not share.
_describing = threading.Lock()


class ForeignTable(RuntimeError):
    """A table of this name is registered with files elsewhere."""


class Warehouse:
    """Tables of all layers below one root folder.

    They are called ``layer.table`` here and registered as ``<prefix>layer.table``. Two roots in
    one catalog need two prefixes; a name that is taken by another root's table is an error.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self._checked: set[str] = set()
        self.log = VersionLog(spark, f"{self.root}/_versions")

    def location(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def registered(self, name: str) -> str:
        """The name in the catalog."""
        return f"{self.prefix}{name}"

    def _check(self, name: str) -> bool:
        """Whether the table is registered; raises if it is another root's."""
        if name in self._checked and self.spark.catalog.tableExists(self.registered(name)):
            return True
        if not self.spark.catalog.tableExists(self.registered(name)):
            return False
        with _describing:
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.registered(name)}").collect()
        places = [r["data_type"] for r in described if r["col_name"] == "Location"]
        if places:
            found, own = qualified(self.spark, places[-1]), qualified(self.spark, self.location(name))
            if found != own and not found.startswith(f"{own}/"):
                raise ForeignTable(f"{self.registered(name)} lies in {found}, not below {self.root}")
        self._checked.add(name)
        return True

    def create(self, *names: str) -> None:
        """Create databases and tables that are missing; existing files are picked up."""
        for layer in LAYERS:
            # Dropping a database deletes its folder, so it gets one that holds no table.
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS {self.prefix}{layer} LOCATION '{self.root}/_catalog/{layer}'"
            )
        for name in names or TABLES:
            if self._check(name):
                continue
            day, known = partition_column(name), self.log.of(name)
            partitioned = f"PARTITIONED BY ({day})" if day else ""
            place = known[None].location if None in known else self.location(name)
            self.spark.sql(
                f"CREATE TABLE {self.registered(name)} ({TABLES[name]}) USING parquet {partitioned} LOCATION '{place}'"
            )
            if day and not exists(self.spark, self.location(name)):
                make_folder(self.spark, self.location(name))
            elif day:
                self.spark.catalog.recoverPartitions(self.registered(name))  # of tables written by others
                self._point(name, known.values())

    def forget(self) -> None:
        """Take this root's tables, and databases that are then empty, from the catalog; files stay."""
        for name in TABLES:
            if self._check(name):
                self.spark.sql(f"DROP TABLE {self.registered(name)}")
        self._checked.clear()
        for layer in LAYERS:
            database = f"{self.prefix}{layer}"
            if not self.spark.catalog.databaseExists(database) or self.spark.catalog.listTables(database):
                continue
            if "/_catalog/" in self.spark.catalog.getDatabase(database).locationUri:
                self.spark.sql(f"DROP DATABASE {database}")

    def table(self, name: str) -> DataFrame:
        self._check(name)
        return self.spark.table(self.registered(name))

    def inventory(self, *names: str) -> DataFrame:
        """``(table_name, day)`` of the stored partitions, from the catalog alone.

        No file is opened. A partition that was cleared counts as stored.
        """
        frames = [
            self.spark.sql(f"SHOW PARTITIONS {self.registered(name)}").select(
                F.lit(name).alias("table_name"),
                F.to_date(F.substring_index("partition", "=", -1)).alias("day"),
            )
            for name in names
        ]
        return reduce(DataFrame.unionByName, frames)

    def days(self, name: str) -> list[dt.date]:
        """Stored partitions of a table, ascending; from the catalog alone."""
        self.create(name)
        rows = self.inventory(name).where("day IS NOT NULL").collect()
        return sorted(r["day"] for r in rows)

    def filled_days(self, name: str) -> list[dt.date]:
        """Stored partitions that hold rows, ascending; from the catalog and the version log alone."""
        log = self.log.of(name)
        return [d for d in self.days(name) if d not in log or log[d].row_count > 0]

    def _arranged(self, name: str, df: DataFrame) -> DataFrame:
        """Columns by name, in table order and type."""
        return df.select(*[F.col(f.name).cast(f.dataType) for f in table_schema(name)])

    def stage(self, name: str, df: DataFrame, value: dt.date | None = None, many_days: bool = True) -> Staged:
        """Write rows of a table to a new folder; with ``value`` all must be of that partition.

        Rows and NULLs are counted on the way to the files; by partition, where there are
        several, in one scan of what was written.
        """
        self.create(name)
        day, version, rows = partition_column(name), new_version(), self._arranged(name, df)
        path = f"{self.location(name)}/_versions/{version}"
        if value is not None:
            rows, many_days = require_partition(rows, day, F.lit(value)), False
        written, columns = Observation(), rows.columns
        counts = [F.count(F.lit(1)).alias("rows")] + [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
        if day:
            counts.append(F.collect_set(day).alias("days"))  # one entry per partition at most
        placed = rows.hint("rebalance", day) if day and many_days else rows
        writer = placed.observe(written, *counts).write
        (writer.partitionBy(day) if day else writer).parquet(path)
        found = written.get
        whole = {c: found[f"n{i}"] for i, c in enumerate(columns)}
        days = sorted(found["days"]) if day else [None]
        if value is not None and not days:
            self.spark.createDataFrame([], table_schema(name)).drop(day).write.parquet(f"{path}/{day}={value.isoformat()}")
            days = [value]
        if len(days) == 1:
            return Staged(name, version, path, {days[0]: found["rows"]}, {days[0]: whole})
        staged = Staged(name, version, path)
        if not days:
            return staged
        nulls = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns) if c != day]
        by_day = self.staged_rows(staged).groupBy(day).agg(F.count(F.lit(1)).alias("rows"), *nulls).collect()
        kept = [c for c in columns if c != day]
        at = [i for i, c in enumerate(columns) if c != day]
        return Staged(
            name,
            version,
            path,
            {r[day]: r["rows"] for r in by_day},
            {r[day]: {c: r[f"n{i}"] for c, i in zip(kept, at)} | {day: r["rows"] if r[day] is None else 0} for r in by_day},
        )

    def staged_rows(self, staged: Staged) -> DataFrame:
        """What was staged, as rows of the table."""
        return self.spark.read.schema(table_schema(staged.table)).parquet(staged.path)

    def discard(self, staged: Staged) -> None:
        delete_folder(self.spark, staged.path)

    def publish(self, staged: Staged, inputs: Callable[[dt.date | None], Mapping[str, str]] | None = None) -> LoadStats:
        """Point the table at what was staged. ``inputs`` names the versions that a partition was made from."""
        day = partition_column(staged.table)
        days = staged.days if day else (None,)
        published = [
            Published(
                staged.table,
                d,
                staged.version,
                f"{staged.path}/{day}={d.isoformat()}" if day else staged.path,
                staged.row_counts[d],
                dict(staged.nulls[d]),
                dict(inputs(d)) if inputs else {},
            )
            for d in days
        ]
        self.log.append(published)
        self._point(staged.table, published)
        return LoadStats(staged.table, staged.rows, staged.days)

    def _point(self, name: str, published) -> None:
        """Make the catalog show these versions."""
        if not published:
            return
        table, column = self.registered(name), partition_column(name)
        spec = {p.day: f"PARTITION ({column}=DATE'{p.day.isoformat()}')" for p in published if p.day}
        places = {p.day: qualified(self.spark, p.location) for p in published}
        if None in places:
            self.spark.sql(f"ALTER TABLE {table} SET LOCATION '{places[None]}'")
        if spec:
            had = {r["day"] for r in self.inventory(name).collect()}
            new = [d for d in spec if d not in had]
            if new:
                added = " ".join(f"{spec[d]} LOCATION '{places[d]}'" for d in new)
                self.spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
            for d in spec.keys() - set(new):
                self.spark.sql(f"ALTER TABLE {table} {spec[d]} SET LOCATION '{places[d]}'")
        self.spark.catalog.refreshTable(table)

    def settle(self, *names: str) -> None:
        """Point the tables at their newest published versions, where a crash kept a publish from it."""
        self.log.reload()
        for name in names or TABLES:
            self.create(name)
            if self.log.of(name):
                self._point(name, self.log.of(name).values())

    def vacuum(self, older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
        """Delete the files of versions that were replaced before ``older_than``; returns how many."""
        log = self.log.rows().select("table_name", "day", "version", "location", "published_at")
        of_partition = Window.partitionBy("table_name", "day").orderBy("version")
        old = log.withColumn("replaced_at", F.lead("published_at").over(of_partition)).where("replaced_at IS NOT NULL")
        limit = F.current_timestamp() - F.expr(f"INTERVAL {int(older_than.total_seconds())} SECONDS")
        gone = old.where(F.col("replaced_at") <= limit).select("location").distinct().collect()
        for row in gone:
            delete_folder(self.spark, row["location"])
        return len(gone)

    def statistics(self, *names: str) -> DataFrame:
        """``table_name, day, row_count, nulls, published_at`` of the published partitions; no data file is opened."""
        found = self.log.newest().where("day IS NOT NULL").select("table_name", "day", "row_count", "nulls", "published_at")
        return found.where(F.col("table_name").isin(*names)) if names else found

    def replace_partition(self, name: str, df: DataFrame, value: dt.date) -> LoadStats:
        return self.publish(self.stage(name, df, value))

    def replace_present(self, name: str, df: DataFrame, many_days: bool = True) -> LoadStats:
        return self.publish(self.stage(name, df, many_days=many_days))

    def replace_static(self, name: str, df: DataFrame) -> None:
        """Load a table without partitions."""
        self.publish(self.stage(name, df))
