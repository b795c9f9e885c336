"""Numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import is_date

# A measure's first number, a number in running text, a number without separators.
FIRST_NUMBER = r"-?\d+(?:,\d{3})*(?:\.\d+)?"
TEXT_NUMBER = r"-?\d[\d,]*(?:\.\d+)?"
BARE_NUMBER = r"-?\d+(?:\.\d+)?"


def _double(digits: Column) -> Column:
    return F.nullif(F.replace(digits, F.lit(","), F.lit("")), F.lit("")).try_cast("double")


def measure(value: Column, field: Column | None = None) -> Column:
    """The first number of a value, unless it is a date. Scale words don't multiply."""
    return F.when(~is_date(value, field), _double(F.regexp_extract(value, FIRST_NUMBER, 0)))


def first_number(value: Column) -> Column:
    """The first number once thousands separators are gone; dates aren't told apart."""
    return _double(F.regexp_extract(F.replace(value, F.lit(","), F.lit("")), BARE_NUMBER, 0))


def numbers_in(text: Column) -> Column:
    """All numbers of a text."""
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TEXT_NUMBER), F.lit(0)), _double)


def is_round(n: Column) -> Column:
    """Zero or a multiple of a hundred, as on a chart's scale."""
    return F.abs(n) % 100 == 0


def has_number(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(TEXT_NUMBER)


def has_digit(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(r"\d")


def rounded(value: Column, places: int = 4) -> Column:
    """A number for display: rounded half to even; null stays null."""
    return F.bround(value, places)


def percent(share: Column) -> Column:
    """A share as per cent with one digit; ``n/a`` if it is null."""
    return F.when(share.isNotNull(), F.format_string("%.1f%%", share.cast("double") * 100)).otherwise("n/a")
