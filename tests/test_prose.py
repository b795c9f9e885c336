"""Values of figures: the title is looked for once a text; cheaper patterns find the same."""

import re

from pyspark.sql import functions as F

from gleanframe.functions.text import last_words, squeezed
from gleanframe.operators import prose


def test_title_once_a_text(spark):
    df = spark.range(1).select(F.lit("Titled 'A' with x at $1m, y AND z of 2%").alias("description"))
    out = prose.figure_values(df)
    assert [(r.canonical_metric.split(" | ")[0], r.value) for r in out.orderBy("n").collect()] == [("A", "$1m"), ("A", "2%")]
    lines = spark.createDataFrame([("a",)], "description string").select("description")
    plan = prose.figure_values(lines)._jdf.queryExecution().optimizedPlan().toString()
    assert all("Generate" in line for line in plan.splitlines() if "titled" in line)  # not in a projection of the values' rows


def test_white_space_and_labels_as_before(spark):
    texts = ["", " a  b\t", "a b", "x  \n y", "a b c", " ", "sales, and Brand is", "sand; shows: at x,", "ANDY and", "a,and b", "the total of all shows profit about"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    clause = F.regexp_replace("t", r"(?i)^.*(?:,|;|\band\b)", "")
    fillers = r"(?i)\b(?:at|of|is|was|are|reached|reaching|peaking|approximately|approx|about|around|roughly|circa|=|:|to)\b"
    plain = F.regexp_replace(F.regexp_replace(clause, fillers, " "), r"(?i).*\b(?:shows?|shown|following|below|are)\b[:\s]*", "")
    old = F.trim(F.regexp_replace("t", r"(?U)\s+", " "))
    for r in df.select("t", squeezed(F.col("t")).alias("a"), old.alias("b"), prose.figure_label(F.col("t")).alias("c"), last_words(plain, 4).alias("d")).collect():
        assert r.a == r.b and not re.search(r"\s\s", r.a)
        assert r.c == r.d, r.t
