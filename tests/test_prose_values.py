"""Values are found by a cheaper pattern, their units told by their ends: the same as by the plain ones."""

import random
import re

from pyspark.sql import functions as F

from gleanframe.functions.text import unit_of
from gleanframe.operators import prose

PLAIN = r"(?:[£$€]\s?\d[\d,]*(?:\.\d+)?\s?(?:m|bn|k|bps|%)?|\d[\d,]*(?:\.\d+)?\s?(?:m|bn|k|bps|%|million|billion))"
PIECES = ["£", "$", "€", "1", "23", "456", ",", ".", " ", "m", "bn", "k", "bps", "%", "million", "Billion", "M", "BN", "K", "Bps", "x", "\u0663", "\u00a0", "\u212a", "\u0001"]


def test_same_values_and_units(spark):
    draw = random.Random(3)
    texts = ["1.15.6m", "1,234.5.6m", "12 345 bps", "£5 and", "£ 5.5.6 K", "5.m", "£5\u212a"] + ["".join(draw.choices(PIECES, k=draw.randint(1, 14))) for _ in range(20000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = lambda pattern: F.regexp_extract_all("t", F.lit(f"((?iU){pattern})"), F.lit(1))
    both = df.select("t", found(prose.VALUE).alias("a"), found(PLAIN).alias("b"))
    assert both.where("a <> b").count() == 0 and both.where("size(a) > 0").count() > 5000
    values = both.select(F.explode("a").alias("v")).select(F.trim("v").alias("v")).distinct()
    assert values.where(~prose._unit(F.col("v")).eqNullSafe(unit_of(F.col("v")))).count() == 0 and values.count() > 1000


def test_a_number_is_tried_once():
    # each digit of a number without a unit was a place to begin, and each shorter number was tried
    assert not re.search(r"\\d\+\)\?(?!\+)", prose.VALUE) and prose.VALUE.count("(?<!\\d)") == 1
