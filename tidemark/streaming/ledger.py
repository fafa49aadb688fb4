"""Which files were handled, in what version.

A ledger is a folder of numbered steps: ``new-<n>`` holds path and modification time of the files
of one batch, ``full-<n>`` all that was known at step n, newest time per path, in the order of time.
A step is written aside and moved into place, so it is seen whole or not at all. Steps up to the
newest full one are left over from an interrupted compaction and are not read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.files import delete_folder, folder_names, swap_folder

KNOWN = "path string, modificationTime timestamp"

# Batches after which the ledger is written anew as one step.
COMPACT_AFTER = 20


class Ledger:
    """Handled files below ``folder``, written by one process at a time."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def steps(self) -> tuple[int, list[int]]:
        """Number of the newest full step (0 without) and of the batches after it."""
        names = [n.split("-") for n in folder_names(self.spark, self.folder)]
        numbers = {kind: [int(n[1]) for n in names if n[0] == kind] for kind in ("full", "new")}
        full = max(numbers["full"], default=0)
        return full, sorted(n for n in numbers["new"] if n > full)

    def rows(self, since: dt.datetime | None = None) -> DataFrame:
        """``(path, modificationTime)``: the newest time of each path, of files changed after ``since``."""
        full, batches = self.steps()
        paths = [f"{self.folder}/full-{full}"] if full else []
        paths += [f"{self.folder}/new-{n}" for n in batches]
        if not paths:
            return self.spark.createDataFrame([], KNOWN)
        known = self.spark.read.schema(KNOWN).parquet(*paths)
        if since is not None:
            known = known.where(F.col("modificationTime") > F.lit(since))
        return known.groupBy("path").agg(F.max("modificationTime").alias("modificationTime"))

    def _store(self, df: DataFrame, name: str) -> None:
        aside = f"{self.folder}/_{name}"
        df.write.mode("overwrite").parquet(aside)
        swap_folder(self.spark, aside, f"{self.folder}/{name}")

    def add(self, files: DataFrame) -> None:
        """Enter the files of one batch."""
        full, batches = self.steps()
        self._store(files.select("path", "modificationTime").coalesce(1), f"new-{max([full, *batches]) + 1}")

    def fresh(self, listing: DataFrame, since: dt.datetime | None = None) -> DataFrame:
        """Files of a listing that are unknown, or newer than they were when they were handled."""
        seen = self.rows(since).select(F.col("path").alias("_path"), F.col("modificationTime").alias("_seen"))
        same = (F.col("path") == F.col("_path")) & (F.col("modificationTime") <= F.col("_seen"))
        return listing.join(seen, same, "left_anti")

    def compact(self, listing: DataFrame | None = None, after: int = COMPACT_AFTER) -> bool:
        """Write all steps as one, if more than ``after`` batches came since the last time.

        With a whole ``listing`` of the watched folder, files that are no longer there are forgotten, so
        the ledger never holds more entries than the folder has files.
        """
        full, batches = self.steps()
        if len(batches) <= after:
            return False
        rows = self.rows()
        if listing is not None:
            rows = rows.join(listing.select("path"), "path", "left_semi")
        ordered = rows.repartitionByRange("modificationTime").sortWithinPartitions("modificationTime")
        newest = batches[-1]
        self._store(ordered, f"full-{newest}")
        for name in folder_names(self.spark, self.folder):
            if name.lstrip("_") != f"full-{newest}" and int(name.split("-")[1]) <= newest:
                delete_folder(self.spark, f"{self.folder}/{name}")
        return True
