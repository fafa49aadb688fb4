"""Ingest snapshot files as they arrive.

The stream reads the folder listing, not the rows: its records are file paths with their
modification times, and the checkpoint remembers which files were handled. Each micro-batch
routes the names, keeps the newest file of every partition, and lands each source with one
partition-replacing write.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.keys import surrogate_key
from tidemark.operators.latest import latest_per_key
from tidemark.scratch import materialize
from tidemark.sinks.warehouse import LoadStats, Warehouse
from tidemark.sources.landing import read_snapshots
from tidemark.sources.routing import route_files
from tidemark.streaming.ledger import Ledger

# The fixed schema of the binary file source.
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def arriving_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Stream of ``path, modificationTime`` of CSV files; file contents are never read."""
    listing = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", "*.[cC][sS][vV]")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return listing.select("path", "modificationTime")


def land_files(warehouse: Warehouse, files: DataFrame) -> list[LoadStats]:
    """Land the newest file of every (source, partition) among ``files``.

    Only file names are collected, at most one micro-batch of them. A header-only file
    clears its partition.
    """
    routed = route_files(files, "path")
    newest = latest_per_key(routed, ["source", "partition_day"], ["modificationTime", "path"])
    by_source: dict[str, dict] = {}
    for row in newest.select("source", "partition_day", "path").collect():
        by_source.setdefault(row.source, {})[row.partition_day] = row.path
    stats = []
    for source, paths in sorted(by_source.items()):
        rows = read_snapshots(warehouse.spark, source, sorted(paths.values()))
        loaded = warehouse.replace_present(f"raw.{source}", rows)
        stats.append(loaded)
        for day in sorted(set(paths) - set(loaded.days)):
            empty = rows.where(F.lit(False))
            stats.append(warehouse.replace_partition(f"raw.{source}", empty, day))
    return stats


def ingest(
    warehouse: Warehouse, folder: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Land all files that arrived since the last call, then stop.

    A path is handled once. Files that are dropped again under their old name are found by
    ``ingest_changes``.
    """

    def land(batch: DataFrame, _: int) -> None:
        land_files(warehouse, batch)

    return (
        arriving_files(warehouse.spark, folder, files_per_batch)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_changes(
    warehouse: Warehouse,
    folder: str,
    ledger: str,
    files_per_batch: int = 1000,
    since: dt.datetime | None = None,
) -> list[LoadStats]:
    """Land files that are new, or newer than when they were last landed; file contents are only read then.

    ``ledger`` is a folder that keeps path and modification time of every landed file (see ``Ledger``).
    Files are landed in the order of their times, ``files_per_batch`` at a time, so that no more names
    than that are on the driver. A batch is entered after its partitions are written; an interrupted call
    lands at most that batch again. With ``since``, only files changed after it are listed and compared;
    without, a file that arrives with an old time is found as well.
    """
    spark = warehouse.spark
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.[cC][sS][vV]")
    if since is not None:
        utc = since.astimezone(dt.timezone.utc)
        reader = reader.option("modifiedAfter", utc.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    listing = materialize(reader.load(folder).select("path", "modificationTime"), "listing")
    known = Ledger(spark, ledger)
    batch = F.floor((F.col("_n") - 1) / files_per_batch)
    fresh = surrogate_key(known.fresh(listing, since), "_n", ["modificationTime", "path"])
    fresh = materialize(fresh.withColumn("_batch", batch), "arrivals")
    batches = (fresh.agg(F.max("_batch")).first()[0] or 0) + 1
    stats = []
    for number in range(batches):
        files = fresh.where(F.col("_batch") == number).select("path", "modificationTime")
        if files.isEmpty():
            break
        stats += land_files(warehouse, files)
        known.add(files)
    known.compact(listing if since is None else None)
    return stats
