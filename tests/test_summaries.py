from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan_of, tuples
from tidemark.operators import features, summaries

D = [dt.date(2026, 4, d) for d in range(1, 11)]
FACT = "customer_key int, order_number string, sales_amount int, quantity int, order_date date"
DIM = "customer_key int, name string"


def test_customer_summary(frame):
    fact = frame(
        [
            (1, "a", 10, 1, D[0]),
            (1, "a", None, 2, D[4]),
            (1, None, 20, None, None),
            (2, "b", None, None, None),
            (None, "c", 5, 1, D[0]),  # no customer
            (9, "d", 5, 1, D[0]),  # unknown customer
        ],
        FACT,
    )
    dim = frame([(1, "Ann"), (2, None), (3, "Cleo")], DIM)
    found = summaries.customer_summary(fact, dim, ["customer_key"], ["name"])
    assert tuples(found) == [
        (1, "Ann", 2, 30, 3, 15.0, D[0], D[4], 4),
        (2, None, 1, None, None, None, None, None, None),
    ]


def test_repeated_dimension_rows_multiply_like_a_plain_join(frame):
    fact = frame([(1, "a", 10, 1, D[0]), (1, "b", 30, 1, D[1])], FACT)
    dim = frame([(1, "Ann"), (1, "Ann"), (1, "Bea")], DIM)
    found = summaries.customer_summary(fact, dim, ["customer_key"], ["name"])
    plain = (
        fact.join(dim, "customer_key").groupBy("customer_key", "name")
        .agg(F.count("order_number"), F.sum("sales_amount"), F.sum("quantity"), F.avg("sales_amount"))
    )
    assert tuples(found.drop("first_order_date", "last_order_date", "days_since_first_order")) == tuples(plain)


def test_facts_are_aggregated_before_the_join(frame):
    fact = frame([(1, "a", 10, 1, D[0])], FACT)
    plan = plan_of(summaries.customer_summary(fact, frame([(1, "Ann")], DIM), ["customer_key"], ["name"]))
    join = plan.index("Join")
    assert "partial_count" in plan[join:], "partial aggregation belongs below the join"


def test_product_summary_profit_needs_both_amounts(frame):
    schema = "product_key int, order_number string, sales_amount int, quantity int, sls_price double, order_date date"
    fact = frame(
        [(1, "a", 10, 2, 5.0, D[0]), (1, "b", None, 3, None, D[1]), (1, "c", 7, None, 7.0, None), (2, "d", 4, 1, 4.0, D[0])],
        schema,
    )
    dim = frame([(1, 3), (2, None)], "product_key int, cost int")
    found = summaries.product_summary(fact, dim, ["product_key"], ["cost"])
    plain = (
        fact.join(dim, "product_key").groupBy("product_key", "cost")
        .agg(
            F.count("order_number"), F.sum("sales_amount"), F.sum("quantity"), F.avg("sales_amount"),
            F.avg("sls_price"), F.sum(F.col("quantity") * F.col("cost")),
            F.sum(F.col("sales_amount") - F.col("quantity") * F.col("cost")),
            F.min("order_date"), F.max("order_date"),
        )
    )
    assert tuples(found) == tuples(plain)
    assert {r.product_key: r.total_profit for r in found.collect()} == {1: 4, 2: None}


def test_top_rows_settles_ties(frame):
    df = frame([(3, 5), (1, 5), (2, 9), (4, None)], "k int, v int")
    assert [r.k for r in summaries.top_rows(df, "v", ["k"], 3).collect()] == [2, 1, 3]


def test_load_stats(frame):
    df = frame([(D[0], 1, True), (D[0], 1, False), (D[0], 2, None), (D[1], 1, False)], "d date, u int, f boolean")
    found = tuples(summaries.load_stats(df, "d", "u", F.col("f")))
    assert found == [(D[0], 3, 2, 0.5, 1), (D[1], 1, 1, 0.0, 0)]


def test_rfm_drops_customers_without_order(frame):
    df = frame([(1, D[0], 3, 50), (2, None, 1, 5)], "k int, last_order_date date, total_orders bigint, total_sales bigint")
    found = features.rfm_features(df, F.lit(D[9]), ["k"])
    assert tuples(found) == [(1, 9, 3, 50.0)]
    assert dict(found.dtypes) == {"k": "int", "recency_days": "int", "frequency": "int", "monetary": "double"}


def test_standardize_per_day_with_constant_column(frame):
    df = frame([(D[0], 1, 7), (D[0], 3, 7), (D[1], 100, 1)], "day date, a int, b int")
    found = tuples(features.standardize(df, ["a", "b"], "day").select("day", "a", "a_z", "b_z"))
    assert found == [(D[0], 1, -1.0, 0.0), (D[0], 3, 1.0, 0.0), (D[1], 100, 0.0, 0.0)]


def test_churn_label_uses_the_greater_of_threshold_and_median(frame):
    rows = [(D[0], r) for r in (10, 95, 100, 300)] + [(D[1], r) for r in (10, 20, 91)]
    df = frame(rows, "day date, recency_days int")
    # Median of the first day is 97.5, of the second 20, where 90 applies.
    assert tuples(features.churn_label(df, "day")) == [
        (D[0], 10, 0), (D[0], 95, 0), (D[0], 100, 1), (D[0], 300, 1),
        (D[1], 10, 0), (D[1], 20, 0), (D[1], 91, 1),
    ]


def test_recency_equal_to_the_median_is_not_churned(frame):
    df = frame([(D[0], 200)] * 3 + [(D[0], 201)], "day date, recency_days int")
    assert sum(r.churned for r in features.churn_label(df, "day").collect()) == 1


@pytest.mark.parametrize("type_", ["int", "double", "decimal(38,3)"])
def test_median_by_selection_equals_sorting(frame, type_):
    random.seed(5)
    days = {
        D[0]: [random.randint(-500, 500) + random.choice([0, 0.125, 0.5]) for _ in range(601)],
        D[1]: [7.5] * 300 + [random.gauss(0, 1e4) for _ in range(500)],  # one value with a third of the rows
        D[2]: [1, 2],
        D[3]: [3.25],
        None: [random.random() * 1e6 for _ in range(100)],
        D[5]: [None],
    }
    rows = [(day, v if v is None else f"{v:.3f}") for day, values in days.items() for v in values]
    df = frame(rows, "day date, text string").select("day", F.col("text").cast("double").cast(type_).alias("v"))
    values = {}
    for r in df.where("v IS NOT NULL").collect():
        values.setdefault(r.day, []).append(r.v)
    expected = {day: float(statistics.median(v)) for day, v in values.items()}
    for most in (30, 10_000):  # two rounds, none
        found = features.median_of_days(df, "v", "day", most=most, cuts=5).collect()
        assert {r.day: r.median for r in found} == pytest.approx(expected, rel=1e-15)
    assert features.median_of_days(df.where("v > 1e9"), "v", "day").count() == 0


def test_median_of_values_that_agree_as_doubles(frame):
    rows = [(D[0], f"9999999999999999999999999.{i:03d}") for i in range(400)]
    df = frame(rows, "day date, v string").select("day", F.col("v").cast("decimal(38,3)"))
    assert features.median_of_days(df, "v", "day", most=4, cuts=5).first().median == 1e25
