from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import spark_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = spark_session(
        "tidemark-tests",
        "local[8]",
        spark__ui__enabled=False,
        spark__ui__showConsoleProgress=False,
        spark__sql__shuffle__partitions=8,
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows with a DDL schema."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make


def plan_of(df) -> str:
    """Physical plan as text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )


def tuples(df):
    """Rows as sorted tuples; None sorts first."""
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])
