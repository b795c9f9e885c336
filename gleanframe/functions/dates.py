"""Dates in document form: what is one, and where it is found. They stay strings, such as ``Q1 2024``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, forms that are dates by themselves (whole value, any case), names of
# fields that hold dates, a bare year, and the forms searched within a heading, in this order.
MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sep|sept|oct|nov|dec"
DATE_FORMS = [
    r"(?:q[1-4]|h[12])\s*[- ]?\s*\d{4}",
    r"\d{4}\s*[- ]?\s*(?:q[1-4]|h[12])",
    r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}",
    r"\d{4}[/\-.]\d{1,2}[/\-.]\d{1,2}",
    rf"\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}}",
    rf"(?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}}",
    rf"(?:{MONTHS})\s+\d{{4}}",
    rf"\d{{4}}\s+(?:{MONTHS})",
    rf"(?:{MONTHS})",
    rf"\d{{1,2}}[- ](?:{MONTHS})[- ]\d{{2,4}}",
    rf"(?:{MONTHS})[- ]\d{{2,4}}",
    rf"\d{{2,4}}[- ](?:{MONTHS})",
    r"\d{4}[/\-.]\d{1,2}",
    r"\d{1,2}[/\-.]\d{4}",
    rf"(?:end|ended|ending|as at|as of|period end|period ended|period ending|quarter end|quarter ended|quarter ending|half year|year end|year ended|year ending|at)\s+(?:\d{{1,2}}\s+)?(?:{MONTHS})\s+\d{{2,4}}",
    rf"(?:{MONTHS})\s+\d{{4}}(?:\s+(?:year end|end|quarter|half year))?",
]
DATE_FIELDS = "date|period|quarter|half[-_ ]?year|financial[-_ ]?year|fy|as[-_ ]?at|as[-_ ]?of|reporting[-_ ]?date|report[-_ ]?date|month|year[-_ ]?end|period[-_ ]?end|effective[-_ ]?date|valuation[-_ ]?date"
BARE_YEAR = r"(?:19|20)\d{2}"
SEARCHED = [
    r"(?:q[1-4]|h[12])\s*[- ]?\s*\d{4}",
    r"\d{4}\s*[- ]?\s*(?:q[1-4]|h[12])",
    rf"(?:{MONTHS})\s+\d{{4}}",
    r"\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}",
    r"\b(?:19|20)\d{2}\b",
]
ANY_DATE = rf"(?i)^\s*(?:{'|'.join(DATE_FORMS)})\s*$"
YEAR = rf"^\s*{BARE_YEAR}\s*$"
#: What a decimal number looks like, without its thousands separators.
PLAIN_NUMBER = r"^\s*[+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?\s*$"


def is_date_field(field: Column) -> Column:
    return F.coalesce(field, F.lit("")).rlike(f"(?i){DATE_FIELDS}")


def is_date(value: Column, field: Column | None = None) -> Column:
    """Whether a value is a date rather than a measure.

    A decimal number never is, a bare year only if its field's name says so. Null isn't.
    """
    decimal = value.rlike(r"\d\.\d") & F.replace(value, F.lit(","), F.lit("")).rlike(PLAIN_NUMBER)
    year = value.rlike(YEAR) & is_date_field(F.lit(None).cast("string") if field is None else field)
    return F.coalesce(~decimal & (value.rlike(ANY_DATE) | year), F.lit(False))


def report_date(value: Column) -> Column:
    """The value without blanks at its ends if it has the form of a date or bare year, decimals included; else null."""
    return F.when(value.rlike(ANY_DATE) | value.rlike(YEAR), F.trim(value))


def date_within(text: Column) -> Column:
    """The first date inside a text, by the order of forms; null if there is none."""
    found = [F.nullif(F.trim(F.regexp_extract(text, f"(?i){p}", 0)), F.lit("")) for p in SEARCHED]
    return F.coalesce(*found)


def date_of_file(path: Column) -> Column:
    """The date in a file's name, whose underscores and dashes stand for spaces."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return date_within(F.translate(name, "_-", "  "))
