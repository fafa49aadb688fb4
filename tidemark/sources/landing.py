"""Snapshot CSV files as DataFrames with the declared schema of their raw table."""

from __future__ import annotations

import csv
import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.files import exists, first_line
from tidemark.schemas import partition_column, table_schema
from tidemark.sources.routing import DAILY_PREFIXES, MONTHLY_PREFIXES, route_files


# Texts that stand for a missing value, in any column.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Fixed value: whole numbers as files have them, which surely fit an INT without their fraction of zero.
PLAIN_WHOLE = r"^[+-]?[0-9]{1,9}(\.0*)?$"


class MissingSnapshot(FileNotFoundError):
    """The file of a requested partition does not exist."""


def snapshot_file(source: str, day: dt.date) -> str:
    """File name of one partition of a source."""
    for prefix, name in DAILY_PREFIXES.items():
        if name == source:
            return f"{prefix}{day:%Y_%m_%d}.csv"
    for prefix, name in MONTHLY_PREFIXES.items():
        if name == source:
            return f"{prefix}{day:%Y_%m}.csv"
    raise KeyError(source)


def stamp_partition(df: DataFrame, column: str, day: Column | dt.date) -> DataFrame:
    """Fill the partition column: its own value as a DATE where present, else ``day``."""
    fallback = day if isinstance(day, Column) else F.lit(day)
    own = F.col(column).cast("date") if column in df.columns else F.lit(None).cast("date")
    return df.withColumn(column, F.coalesce(own, fallback))


def require_partition(df: DataFrame, column: str, day: Column) -> DataFrame:
    """Raise on a row whose partition value differs from ``day``.

    Such a row would survive the next replacement of its file's partition.
    """
    message = F.concat(
        F.lit(f"{column} "), F.col(column).cast("string"), F.lit(" in the file of "), day.cast("string")
    )
    checked = F.when(F.col(column) == day, F.col(column)).otherwise(
        F.raise_error(message).cast("date")
    )
    return df.withColumn(column, checked)


def _typed(name: str, kind: T.DataType) -> Column:
    """A text column in its declared type.

    Missing markers become NULL. Whole numbers may be written with a fraction of zero, days with
    a time. What does not fit its type fails the read.
    """
    text = F.when(~F.col(name).isin(*MISSING), F.col(name))
    if kind == T.StringType():
        return text.alias(name)
    value = text.try_cast(kind)
    if kind == T.IntegerType():
        number = text.try_cast("double")
        value = F.coalesce(value, F.when(number == F.rint(number), text.try_cast("decimal(38,0)").try_cast("int")))
        # A cast that does not fit throws inside, which takes longer than all other work on a row.
        value = F.when(text.rlike(PLAIN_WHOLE), F.substring_index(text, ".", 1).try_cast(kind)).otherwise(value)
    message = F.concat(F.lit(f"MALFORMED_RECORD: {name} "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(message).cast(kind)).otherwise(value).alias(name)


def _read_csv(
    spark: SparkSession, paths: Sequence[str], header: Sequence[str], schema: T.StructType, multi_line: bool
) -> DataFrame:
    types = {f.name: f.dataType for f in schema}
    unknown = [c for c in header if c not in types]
    lacking = [c for c in types if c not in header and c != partition_of(schema)]
    if unknown or lacking:
        raise ValueError(f"columns of {list(paths)}: unknown {unknown}, missing {lacking}")
    return (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(list(paths))
    )


def partition_of(schema: T.StructType) -> str | None:
    last = schema.names[-1]
    return last if last in ("snapshot_date", "snapshot_month") else None


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([first_line(spark, path)]), ()))


def read_snapshots(
    spark: SparkSession, source: str, paths: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Rows of any number of files of one source, stamped and typed like its raw table.

    The partition comes from each file's name, which is routed once per file and broadcast. Files
    are grouped by their header line, so files with and without the partition column can be mixed.
    Header lines are read without a job. ``multi_line`` allows line breaks inside quoted fields;
    such files are not split.
    """
    table = f"raw.{source}"
    schema = table_schema(table)
    column = partition_column(table)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        by_header.setdefault(_header(spark, path), []).append(path)
    frames = []
    for header, group in by_header.items():
        rows = _read_csv(spark, group, header, schema, multi_line)
        typed = [_typed(c, schema[c].dataType) for c in header]
        names = F.array(*[F.lit(name) for name in sorted({path.rsplit("/", 1)[-1] for path in group})])
        files = spark.range(0, 1, 1, 1).select(F.explode(names).alias("_file"))
        routes = route_files(files, "_file").select("_file", "partition_day")
        rows = rows.select(*typed, F.col("_metadata.file_name").alias("_file")).join(F.broadcast(routes), "_file")
        rows = stamp_partition(rows, column, F.col("partition_day"))
        rows = require_partition(rows, column, F.col("partition_day"))
        frames.append(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema]))
    return reduce(DataFrame.unionByName, frames)


def read_snapshot(
    spark: SparkSession, folder: str, source: str, day: dt.date, multi_line: bool = False
) -> DataFrame:
    """Rows of the file of one partition."""
    path = f"{folder.rstrip('/')}/{snapshot_file(source, day)}"
    if not exists(spark, path):
        raise MissingSnapshot(f"no file {path} for partition {day} of {source}")
    return read_snapshots(spark, source, [path], multi_line)


def read_seed(spark: SparkSession, path: str, table: str, multi_line: bool = False) -> DataFrame:
    """A static reference file with the schema of its table."""
    schema = table_schema(table)
    header = schema.names
    rows = _read_csv(spark, [path], header, schema, multi_line)
    return rows.select(*[_typed(f.name, f.dataType) for f in schema])
