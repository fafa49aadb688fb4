from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import cleansing as c


def apply(frame, rule, values, kind="string"):
    df = frame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in df.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_marital_status(frame):
    values = ["S", " s ", "M", "m", "x", "", None, "Single"]
    found = apply(frame, lambda v: c.standard_code(v, c.MARITAL_STATUS), values)
    assert found == ["Single", "Single", "Married", "Married", "N/A", "N/A", "N/A", "N/A"]


def test_gender_codes_and_words(frame):
    values = ["F", "male", " FEMALE ", "M", "", None]
    assert apply(frame, lambda v: c.standard_code(v, c.GENDER_WORD), values) == [
        "Female", "Male", "Female", "Male", "N/A", "N/A"
    ]
    assert apply(frame, lambda v: c.standard_code(v, c.GENDER_CODE), values) == [
        "Female", "N/A", "N/A", "Male", "N/A", "N/A"
    ]


def test_product_line(frame):
    found = apply(frame, lambda v: c.standard_code(v, c.PRODUCT_LINE), ["R ", "S ", "M", "t", " ", None])
    assert found == ["Road", "Other Sales", "Mountain", "Touring", "N/A", "N/A"]


def test_country_aliases_missing_and_pass_through(frame):
    values = ["US", " usa ", "United States of America", "UK", "de", "FR", None, " ", "n/a", "null", " Spain "]
    assert apply(frame, c.standard_country, values) == [
        "United States", "United States", "United States", "United Kingdom", "Germany", "France",
        "N/A", "N/A", "N/A", "null", "Spain",
    ]


def test_trim_takes_spaces_only(frame):
    assert apply(frame, lambda v: F.trim(v), [" a\t"]) == ["a\t"]


def test_key_by_length(frame):
    values = ["NASAW00011000", "AW00011000", "AW0001100", None]
    assert apply(frame, c.key_by_length, values) == ["AW00011000", "AW00011000", None, None]


def test_key_split(frame):
    assert apply(frame, c.key_head, ["CO-RF-FR-R92B-58"]) == ["CO_RF"]
    assert apply(frame, c.key_tail, ["CO-RF-FR-R92B-58", "AC-HE-HL-U509-R"]) == ["FR_R92B_58", "HL_U509_R"]


def test_guarded_date(frame):
    values = ["20101229", "0", "-2010122", "5489", "32154", None]
    assert apply(frame, c.guarded_date, values) == [dt.date(2010, 12, 29), None, None, None, None, None]


def test_guarded_date_of_numbers(frame):
    assert apply(frame, c.guarded_date, [20101229, 0, None], "int") == [dt.date(2010, 12, 29), None, None]


def test_impossible_date_raises_when_strict_only(frame):
    for impossible in ("20131399", "20130229", "20130100", "20130431"):
        with pytest.raises(Exception, match=f"no such date: {impossible}"):
            apply(frame, c.guarded_date, [impossible])
    values = ["20131399", "2013x101", "20130229", "20120229", "20130100", "20131231"]
    assert apply(frame, lambda v: c.guarded_date(v, strict=False), values) == [
        None, None, None, dt.date(2012, 2, 29), None, dt.date(2013, 12, 31)
    ]


def test_no_future(frame):
    today = dt.date(2026, 4, 1)
    values = [today, dt.date(2026, 4, 2), None]
    assert apply(frame, lambda v: c.no_future(v, F.lit(today)), values, "date") == [today, None, None]


def test_first_known(frame):
    df = frame([("Male", "Female"), ("N/A", "Female"), ("N/A", None), (None, "N/A")], "a string, b string")
    found = [r.g for r in df.select(c.first_known(F.col("a"), F.col("b")).alias("g")).collect()]
    assert found == ["Male", "Female", "N/A", "N/A"]


def test_rounded_int_ties_to_even(frame):
    assert apply(frame, c.rounded_int, [2.5, 3.5, -2.5, 2.4, None], "double") == [2, 4, -2, 2, None]


@pytest.mark.parametrize(
    ("sales", "quantity", "price", "expected"),
    [
        (10, 2, 5, (10, 2, 5.0)),
        (10, 2, -5, (10, 2, 5.0)),  # the price loses its sign
        (None, 2, 5, (10, 2, 5.0)),  # missing sales
        (-4, 2, 5, (10, 2, 5.0)),  # negative sales
        (11, 2, 5, (10, 2, 5.0)),  # inconsistent sales
        (10, 4, None, (10, 4, 2.5)),  # price from sales and quantity
        (10, 4, 0, (0, 4, 0.0)),  # a zero price makes the sales zero first
        (10, 0, 5, (0, 0, 5.0)),
        (10, 0, None, (10, 0, None)),
        (None, None, 5, (None, None, 5.0)),
        (10, None, None, (10, None, None)),
        (None, 3, None, (None, 3, None)),
    ],
)
def test_repair_amounts(frame, sales, quantity, price, expected):
    df = frame([(sales, quantity, price)], "s int, q int, p int")
    assert tuple(c.repair_amounts(df, "s", "q", "p").first()) == expected
