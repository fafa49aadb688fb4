"""Operators and table plans over the benchmark tables, each beside its SQL definition.

The benchmark tables lack the dirt that cleansing rules are for, so several queries first
derive padded codes, broken amounts and date numbers from clean columns. Every row of a
table takes part; the SQL derives the same values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that defines its result."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register
