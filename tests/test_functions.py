"""Worked examples of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from gleanframe.functions import dates, jsonx, match, numbers, text
from gleanframe.sources import files


def of(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("value", "field", "wanted"), [
    ("1252.0", None, False), ("2024", "period", True), ("2024", "headcount", False), ("Q1 2024", None, True), ("31/03/2024", None, True), ("9 March 2024", None, True),
    ("31-Mar-26", None, True), ("Apr-25", None, True), ("2025-04", None, True), ("End June 2025", None, True), ("2025.04", None, False), ("", None, False), (None, None, False), ("the March 2024 report", None, False),
])
def test_is_date(spark, value, field, wanted):
    assert of(spark, dates.is_date(F.lit(value).cast("string"), F.lit(field).cast("string"))) is wanted


@pytest.mark.parametrize(("value", "wanted"), [("2025.04", "2025.04"), (" Q1 2024 ", "Q1 2024"), ("2024", "2024"), ("12", None)])
def test_report_date(spark, value, wanted):
    assert of(spark, dates.report_date(F.lit(value))) == wanted


@pytest.mark.parametrize(("path", "wanted"), [("/a/LCR_BankABC_February_2026.pptx", "February 2026"), ("Micro Report 2024 Q1.pdf", "2024 Q1"), ("untitled", None)])
def test_date_of_file(spark, path, wanted):
    assert of(spark, dates.date_of_file(F.lit(path))) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("~750", 750.0), ("1,234.5%", 1234.5), ("$12.4m", 12.4), ("Q1 2024", None), ("none", None), ("", None)])
def test_measure(spark, value, wanted):
    assert of(spark, numbers.measure(F.lit(value))) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("14.2%", 14.2), ("1,234", 1234.0), ("£5m", 5.0), (" 12.3 bps", 12.3)])
def test_first_number(spark, value, wanted):
    assert of(spark, numbers.first_number(F.lit(value))) == wanted


@pytest.mark.parametrize(("value", "wanted"), [("£125m", "£m"), ("15%", "%"), ("30 bps", "bps"), ("$2 Million", "$m"), ("plain 7", None), (None, None)])
def test_unit(spark, value, wanted):
    got = of(spark, text.unit_of(F.lit(value).cast("string")))
    assert got == wanted or (value == "$2 Million" and got in ("$m", "$million"))


@pytest.mark.parametrize(("id", "wanted"), [("q1_report.pptx-s2-img0", "q1_report.pptx"), ("x.pdf-pNone-fig", "x.pdf-pNone-fig"), ("x.pdf-p3-aiparsetxt", "x.pdf"), ("", None)])
def test_source_document(spark, id, wanted):
    assert of(spark, text.source_document(F.lit(id))) == wanted


@pytest.mark.parametrize(("wanted", "found", "yes"), [("net revenue", "revenue", True), ("a b c", "a x", False), ("a b c", "b a", True), ("a b c d e", "a b", False), ("", "z", True)])
def test_field_matches(spark, wanted, found, yes):
    assert of(spark, match.field_matches(F.lit(wanted), F.lit(found))) is yes


def test_value_matches(spark):
    assert of(spark, match.value_matches(F.lit("£1,000"), F.lit("1000"), F.lit("table")))
    assert of(spark, match.value_matches(F.lit("103"), F.lit("100"), F.lit("figure")))
    assert not of(spark, match.value_matches(F.lit("103"), F.lit("100"), F.lit("table")))
    assert not of(spark, match.value_matches(F.lit(None).cast("string"), F.lit("100"), F.lit("figure")))


@pytest.mark.parametrize(("raw", "n"), [('[{"a":1},3]', 1), ('so: [{"a":1},{"b":2}] ok', 2), ("[broken", 0), (None, 0), ("[]", 0)])
def test_points_in(spark, raw, n):
    assert len(of(spark, jsonx.points_in(F.lit(raw).cast("string")))) == n


def test_paths_and_names(spark):
    assert of(spark, text.storage_path(F.lit("store:/volumes/a"))) == "/volumes/a"
    assert of(spark, files.entity_of_file_name(F.lit("A12_Bank_Report_2024-01-31.pdf"))) == "A12"
    assert of(spark, files.entity_of_file_name(F.lit("report.pdf"))) is None
