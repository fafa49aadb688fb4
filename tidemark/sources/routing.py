"""From the name of a dropped file to its source, cadence and partition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.cleansing import decode

# File name prefix of each source, by cadence.
DAILY_PREFIXES = {
    "sales_details_": "sales_details",
    "cust_info_": "cust_info",
    "loc_a101_": "loc_a101",
}
MONTHLY_PREFIXES = {"prd_info_": "prd_info"}

# File name formats. Letter case does not matter.
DAILY_NAME = r"(?i)^([a-z0-9_]+_)(\d{4}_\d{2}_\d{2})\.csv$"
MONTHLY_NAME = r"(?i)^([a-z0-9_]+_)(\d{4}_\d{2})\.csv$"


def _routed(name: Column, pattern: str, prefixes: Mapping[str, str], cadence: str) -> Column:
    """Struct of source, cadence and partition day; NULL when the name does not fit."""
    prefix = F.lower(F.regexp_extract(name, pattern, 1))
    stamp = F.regexp_extract(name, pattern, 2)
    stamp = F.concat(stamp, F.lit("_01")) if cadence == "monthly" else stamp
    day = F.try_to_date(F.when(prefix.isin(*prefixes), stamp), "yyyy_MM_dd")
    fields = F.struct(
        decode(prefix, prefixes).alias("source"), F.lit(cadence).alias("cadence"), day.alias("day")
    )
    return F.when(day.isNotNull(), fields)


def route_files(
    files: DataFrame,
    name: str,
    daily: Mapping[str, str] = DAILY_PREFIXES,
    monthly: Mapping[str, str] = MONTHLY_PREFIXES,
) -> DataFrame:
    """Add ``source``, ``cadence`` and ``partition_day``; unknown names are left out.

    Monthly names are tried first. A monthly file belongs to the first day of its month.
    """
    base = F.element_at(F.split(F.col(name), "/"), -1)
    routes = []
    if monthly:
        routes.append(_routed(base, MONTHLY_NAME, monthly, "monthly"))
    if daily:
        routes.append(_routed(base, DAILY_NAME, daily, "daily"))
    routed = files.withColumn("_route", F.coalesce(*routes)).where(F.col("_route").isNotNull())
    return routed.select(
        *files.columns,
        F.col("_route.source").alias("source"),
        F.col("_route.cadence").alias("cadence"),
        F.col("_route.day").alias("partition_day"),
    )
