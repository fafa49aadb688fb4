"""Durable intermediate tables in the cluster's shared folder.

Lineage is cut by writing a table that every executor can reach, so a lost executor
costs a re-read and never a recomputation with different partition bounds.
"""

from __future__ import annotations

import contextlib
import contextvars
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession

from tidemark.files import delete_folder


_created: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("created", default=None)


@functools.cache
def _local_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused between calls."""
    application = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/tidemark/{application}/{label}-{uuid.uuid4().hex}"
    created = _created.get()
    if created is not None:
        created.append(path)
    return path


@contextlib.contextmanager
def discarding(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving the block, the scratch tables that were written inside it.

    For jobs that write their final result inside the block. A frame returned from it may
    still need its scratch table.
    """
    created: list[str] = []
    token = _created.set(created)
    try:
        yield
    finally:
        _created.reset(token)
        for path in created:
            delete_folder(spark, path)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Inside the block a query's shuffle files go when it ends, not when the driver next collects garbage.

    For steps that continue from written tables. A setting that the session has is left as it is; a
    version of Spark that lacks it keeps the files until then.
    """
    if SHUFFLE_CLEANUP in spark.conf.getAll:
        yield
        return
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def materialize_last(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Write the frame that ``make`` gives, delete the scratch tables that ``make`` wrote, and continue from the written one."""
    path = scratch_path(spark, label)
    with discarding(spark):
        df = make()
        df.write.parquet(path)
        schema = df.schema
    return spark.read.schema(schema).parquet(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
