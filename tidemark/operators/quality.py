"""Declared data tests, evaluated as one result frame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    """The column has no NULL; a failure is a row."""

    column: str
    severity: str = "error"


@dataclass(frozen=True)
class UniqueCombination:
    """The columns identify a row (NULLs are equal); a failure is a repeated combination."""

    columns: tuple[str, ...]
    severity: str = "error"


DataTest = NotNull | UniqueCombination


class DataTestFailure(RuntimeError):
    """A test of severity ``error`` failed; ``staged`` are the rows, where they were not published."""

    def __init__(self, message: str, staged: object = None):
        super().__init__(message)
        self.staged = staged


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, failures)``: NULLs of every column, all counted in one pass."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("failures"))
        for i, c in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*pairs)))


def duplicate_groups(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their row count."""
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)
    )


def audit(df: DataFrame, table: str, tests: Sequence[DataTest]) -> DataFrame:
    """Run the declared tests of one table, in one scan: one row per test.

    Rows are counted by every tested combination of columns at once (grouping sets); NULLs are
    counted along with the first combination, and summed up at the end.
    """
    not_null = [t for t in tests if isinstance(t, NotNull)]
    unique = [t for t in tests if isinstance(t, UniqueCombination)]
    sets = list(dict.fromkeys(tuple(sorted(t.columns)) for t in unique))
    columns = sorted({c for s in sets for c in s})
    nulls = [F.count_if(F.col(t.column).isNull()).alias(f"_null{i}") for i, t in enumerate(not_null)]
    zero = F.lit(0).cast("bigint")
    if sets:
        counted = df.select(*columns, *[F.col(t.column).alias(f"_tested{i}") for i, t in enumerate(not_null)])
        nulls = [F.count_if(F.col(f"_tested{i}").isNull()).alias(f"_null{i}") for i in range(len(not_null))]
        groups = counted.groupingSets([[F.col(c) for c in s] for s in sets], *columns)
        groups = groups.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows"), *nulls)
        # Bits of the set's number, from the first column, are 1 for columns that are not in it.
        numbers = {s: int("".join("01"[c not in s] for c in columns), 2) for s in sets}
        of = {s: F.col("_set") == number for s, number in numbers.items()}
        totals = [F.sum(F.when(of[sets[0]], F.col(f"_null{i}"))).alias(f"_null{i}") for i in range(len(not_null))]
        totals += [F.count_if(of[s] & (F.col("_rows") > 1)).alias(f"_twice{i}") for i, s in enumerate(sets)]
        counts = groups.agg(*totals)
    else:
        counts = df.agg(*nulls)
    entries = [("not_null", t.column, t.severity, f"_null{i}") for i, t in enumerate(not_null)]
    entries += [
        ("unique_combination", ",".join(t.columns), t.severity, f"_twice{sets.index(tuple(sorted(t.columns)))}")
        for t in unique
    ]
    rows = [
        F.struct(
            F.lit(test).alias("test"),
            F.lit(names).alias("column_names"),
            F.lit(severity).alias("severity"),
            F.coalesce(F.col(found), zero).alias("failures"),
        )
        for test, names, severity, found in entries
    ]
    report = counts.select(F.inline(F.array(*rows)))
    status = F.when(F.col("failures") == 0, "pass").otherwise(
        F.when(F.col("severity") == "error", "fail").otherwise("warn")
    )
    return report.select(F.lit(table).alias("table_name"), "*", status.alias("status"))


def audit_all(tables: Mapping[str, tuple[DataFrame, Sequence[DataTest]]]) -> DataFrame:
    """One report over several tables."""
    return reduce(
        DataFrame.unionByName, [audit(df, name, tests) for name, (df, tests) in tables.items()]
    )


def not_null_results(table: str, tests: Sequence[NotNull], nulls: Mapping[str, int]) -> list[Row]:
    """Results of not-null tests from NULLs that were counted before, in the shape of ``audit``."""
    results = []
    for test in tests:
        failures = nulls.get(test.column, 0)
        status = "pass" if failures == 0 else "fail" if test.severity == "error" else "warn"
        results.append(
            Row(table_name=table, test="not_null", column_names=test.column, severity=test.severity, failures=failures, status=status)
        )
    return results


def enforce(report: DataFrame) -> list:
    """Raise if a test of severity ``error`` failed; the other results are returned.

    The report has one row per declared test, so collecting it is bounded by the declarations.
    """
    return require(report.collect())


def require(results: list) -> list:
    """Raise if one of the results is that of a failed test of severity ``error``."""
    failed = [f"{r.table_name}: {r.test}({r.column_names}) {r.failures}" for r in results if r.status == "fail"]
    if failed:
        raise DataTestFailure("; ".join(failed))
    return results


def rowcount_drift(df: DataFrame, day: str, low: float = 0.8, high: float = 1.2) -> DataFrame:
    """Rows of each day against the calendar day before, which counts as 1 when empty.

    Each day's count is sent to its own day and to the next one, so the table is read once.
    """
    counts = df.where(F.col(day).isNotNull()).groupBy(F.col(day).alias("day"))
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    none = F.lit(0).cast("bigint")
    here = F.struct("day", F.col("n").alias("row_count"), none.alias("previous_count"))
    onward = F.struct(
        F.date_add("day", 1).alias("day"), none.alias("row_count"), F.col("n").alias("previous_count")
    )
    paired = counts.select(F.inline(F.array(here, onward))).groupBy("day")
    paired = paired.agg(*[F.sum(c).alias(c) for c in ("row_count", "previous_count")])
    ratio = F.col("row_count") / F.greatest(F.col("previous_count"), F.lit(1))
    compared = paired.where(F.col("row_count") > 0).withColumn("ratio", ratio)
    return compared.withColumn("passed", F.col("ratio").between(low, high))
