"""The log of published partition versions.

Every publish adds one small file with a row per partition: which version the partition has now,
where its files lie, what it holds, and which versions of other tables it was made from. A version is
named by its time, so of two versions of a partition the greater name is the newer one. The
log answers questions about partitions without opening a data file.
"""

from __future__ import annotations

import datetime as dt
import json
import threading
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidemark.files import exists, write_text
from tidemark.operators.latest import latest_per_key

# How an input partition is found for the day of a partition that reads it.
SAME_DAY = "day"  # the partition of that day
NEWEST = "newest"  # the newest partition on or before that day
HISTORY = "history"  # all partitions on or before that day
STATIC = "static"  # the table has no partitions

LOG_SCHEMA = (
    "table_name string, day date, version string, location string, row_count bigint, "
    "nulls map<string, bigint>, inputs map<string, string>, published_at timestamp"
)


def new_version() -> str:
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


@dataclass(frozen=True)
class Published:
    """One version of one partition; a table without partitions has no day."""

    table_name: str
    day: dt.date | None
    version: str
    location: str
    row_count: int
    nulls: dict[str, int] = field(default_factory=dict)
    inputs: dict[str, str] = field(default_factory=dict)


class VersionLog:
    """Published versions below one folder.

    The newest version of each partition is also held by the driver: one row per table and
    calendar day, whatever the size of the tables.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._newest: dict[str, dict[dt.date | None, Published]] | None = None
        self._lock = threading.RLock()  # tables are built side by side

    def rows(self) -> DataFrame:
        """Every version that was ever published."""
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).json(self.folder)

    def newest(self) -> DataFrame:
        """The newest version of each partition."""
        return latest_per_key(self.rows().drop("nulls", "inputs"), ["table_name", "day"], ["version"]).join(
            self.rows().select("table_name", "version", "day", "nulls", "inputs").withColumnRenamed("day", "_day"),
            ["table_name", "version"],
        ).where("day <=> _day").drop("_day")

    def append(self, published: Iterable[Published]) -> None:
        """Add the versions of one publish; they are seen together or not at all."""
        rows = list(published)
        if not rows:
            return
        now = dt.datetime.now(dt.timezone.utc).isoformat()
        lines = [
            json.dumps({**vars(r), "day": r.day.isoformat() if r.day else None, "published_at": now}) for r in rows
        ]
        write_text(self.spark, f"{self.folder}/{rows[0].version}.json", "\n".join(lines))
        with self._lock:
            for r in rows:
                self._held().setdefault(r.table_name, {})[r.day] = r

    def reload(self) -> None:
        """Forget what is held, so that others' publishes are seen."""
        with self._lock:
            self._newest = None

    def _held(self) -> dict[str, dict[dt.date | None, Published]]:
        with self._lock:
            if self._newest is None:
                held: dict[str, dict[dt.date | None, Published]] = {}
                for r in self.newest().collect() if exists(self.spark, self.folder) else ():
                    held.setdefault(r["table_name"], {})[r["day"]] = Published(
                        r["table_name"], r["day"], r["version"], r["location"], r["row_count"], r["nulls"] or {}, r["inputs"] or {}
                    )
                self._newest = held
            return self._newest

    def of(self, table: str) -> dict[dt.date | None, Published]:
        """The newest version of each partition of a table, by day."""
        with self._lock:
            return dict(self._held().get(table, {}))

    def noted(self, reads: Mapping[str, str]) -> Inputs:
        """The inputs of a build as they are now; later publishes do not change them."""
        return Inputs({name: (kind, {d: p.version for d, p in self.of(name).items()}) for name, kind in reads.items()})


class Inputs:
    """Versions of the partitions of some input tables at one moment."""

    def __init__(self, tables: Mapping[str, tuple[str, Mapping[dt.date | None, str]]]):
        self._tables = tables

    def __call__(self, day: dt.date | None) -> dict[str, str]:
        """The versions that a partition of ``day`` is made from; absent inputs are left out.

        For a whole history it is the greatest of all versions up to that day: any partition that
        is added or published again makes it greater.
        """
        found = {}
        for name, (kind, versions) in self._tables.items():
            if kind == STATIC:
                seen = versions.get(None)
            else:
                days = [d for d in versions if d is not None and d <= day]
                if kind == SAME_DAY:
                    seen = versions.get(day)
                elif kind == NEWEST:
                    seen = versions[max(days)] if days else None
                else:
                    seen = max((versions[d] for d in days), default=None)
            if seen is not None:
                found[name] = seen
        return found
