"""Cleansing rules as column expressions. No Python runs per row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_AVAILABLE = "N/A"

# Source codes (trimmed, upper case) and the labels they stand for.
MARITAL_STATUS = {"S": "Single", "M": "Married"}
GENDER_CODE = {"F": "Female", "M": "Male"}
GENDER_WORD = {"M": "Male", "MALE": "Male", "F": "Female", "FEMALE": "Female"}
PRODUCT_LINE = {"M": "Mountain", "R": "Road", "S": "Other Sales", "T": "Touring"}
COUNTRY = {
    "US": "United States",
    "USA": "United States",
    "UNITED STATES OF AMERICA": "United States",
    "UK": "United Kingdom",
    "DE": "Germany",
    "FR": "France",
}
COUNTRY_MISSING = ("N/A", "")


def code_form(column: Column) -> Column:
    """The form in which codes are compared: surrounding spaces off, upper case."""
    return F.upper(F.trim(column))


def decode(column: Column, labels: Mapping, default: Column | str | None = None) -> Column:
    """Replace each value by its label; values that share a label share one branch."""
    branches: dict[str, list] = {}
    for code, label in labels.items():
        branches.setdefault(label, []).append(code)
    result = None
    for label, codes in branches.items():
        hit = column.isin(*codes)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    if result is None:
        raise ValueError("labels must not be empty")
    fallback = default if isinstance(default, Column) else F.lit(default)
    return result.otherwise(fallback)


def standard_code(column: Column, labels: Mapping[str, str], default: str = NOT_AVAILABLE) -> Column:
    """Label of a padded, mixed-case code; anything unknown, blank or NULL gets ``default``."""
    return decode(code_form(column), labels, default)


def standard_country(column: Column) -> Column:
    """Known aliases become names, missing markers become N/A, other text is only trimmed.

    The text ``null`` is not a missing marker: it passes through as it is.
    """
    code = code_form(column)
    kept = F.when(column.isNull() | code.isin(*COUNTRY_MISSING), F.lit(NOT_AVAILABLE)).otherwise(
        F.trim(column)
    )
    return decode(code, COUNTRY, kept)


def key_by_length(
    column: Column, drop_prefix: Mapping[int, int] = {13: 3}, keep: Sequence[int] = (10,)
) -> Column:
    """Normalise a key by its length: drop a known prefix, keep as is, else NULL."""
    size = F.length(column)
    result = F.when(size.isin(*keep), column)
    for length, prefix in drop_prefix.items():
        result = result.when(size == length, F.substring(column, prefix + 1, length - prefix))
    return result


def key_head(column: Column, size: int = 5) -> Column:
    """Leading part of a composite key, with ``-`` turned into ``_``."""
    return F.replace(F.substring(column, 1, size), F.lit("-"), F.lit("_"))


def key_tail(column: Column, start: int = 7) -> Column:
    """Rest of a composite key from position ``start``, with ``-`` turned into ``_``."""
    return F.replace(F.substr(column, F.lit(start)), F.lit("-"), F.lit("_"))


def guarded_date(column: Column, strict: bool = True) -> Column:
    """Date of a ``yyyyMMdd`` number or text.

    NULL, zero, negative and wrong-length values become NULL. An impossible date of the
    right length raises when ``strict`` and becomes NULL otherwise.
    """
    text = column.cast("string")
    number = text.cast("int") if strict else text.try_cast("int")
    # The cast of ISO text needs no date pattern and no exception for a value it refuses.
    iso = F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    day = iso.try_cast("date")
    if strict:
        no_such_date = F.raise_error(F.concat(F.lit("no such date: "), text)).cast("date")
        day = F.coalesce(day, no_such_date)
    return F.when((number > 0) & (F.length(text) == 8), day)


def no_future(column: Column, today: Column) -> Column:
    """NULL for dates after ``today``; the clock is an argument so that reruns agree."""
    return F.when(column > today, None).otherwise(column)


def first_known(*columns: Column, missing: str = NOT_AVAILABLE) -> Column:
    """First value that is neither NULL nor the missing marker, else the marker."""
    return F.coalesce(*[F.nullif(c, F.lit(missing)) for c in columns], F.lit(missing))


def rounded_int(column: Column) -> Column:
    """Whole number of a fractional value, ties to even (a plain cast would truncate)."""
    return F.bround(column).cast("int")


def repair_amounts(df: DataFrame, sales: str, quantity: str, price: str) -> DataFrame:
    """Make sales, quantity and unit price agree, in three ordered steps.

    The price loses its sign; sales are recomputed when missing, not positive or different
    from quantity x price; a missing or zero price is then derived from sales and quantity,
    which makes the repaired price a double.
    """
    expected = F.col(quantity) * F.col(price)
    # An unknown product of quantity and price cannot contradict the sales.
    consistent = (F.col(sales) > 0) & F.coalesce(F.col(sales) == expected, F.lit(True))
    usable_price = F.nullif(F.col(price), F.lit(0))
    per_unit = F.try_divide(F.col(sales).cast("double"), F.col(quantity))
    return (
        df.withColumn(price, F.abs(F.col(price)))
        .withColumn(sales, F.when(consistent, F.col(sales)).otherwise(expected))
        .withColumn(price, F.coalesce(usable_price, per_unit, F.col(price)).cast("double"))
    )
