"""Site-relative line frequency: lines on too large a share of a host's pages are boilerplate.

DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged


def _line(x: Column) -> Column:
    """A line as it is compared: without blanks, tabs and carriage returns at its ends."""
    return F.btrim(x, F.lit(" \t\r"))


def _key(line: Column) -> Column:
    return F.substring(F.sha2(line, 256), 1, 32)


def _keys(text: str) -> Column:
    """128 bits of the SHA-256 of each different line of a text, as text, so that Spark compares lists of them by hashing."""
    return F.array_distinct(F.transform(F.filter(F.transform(F.split(text, "\n"), _line), lambda x: x != ""), _key))


def boilerplate(docs: DataFrame, host: str, text: str, percent: int, min_pages: int = 1, others: bool = False) -> DataFrame:
    """(host, lines) of hosts with boilerplate; null hosts are one host, written as null.

    A host has at most (distinct lines of its average page) x 100 / ``percent`` such lines, so the
    list of a host stays small however many pages it has. By the ratio alone (``min_pages`` 1, not
    ``others``) that is every line of a host of fewer than 100 / ``percent`` pages: over a corpus of
    such hosts the lists together grow with it.
    """
    pages = docs.select(F.col(host).alias("host"), _keys(text).alias("lines"))
    totals = pages.groupBy(F.col("host").alias("of")).agg(F.count("*").alias("total"))
    counts = pages.select("host", F.explode("lines").alias("line")).groupBy("host", "line").agg(F.count("*").alias("pages"))
    common = counts.where(F.col("pages") >= min_pages).join(totals, F.col("host").eqNullSafe(F.col("of")))
    own = int(others)  # a page that says nothing about its own lines
    over = common.where((F.col("pages") - own) * 100 > (F.col("total") - own) * percent).select("host", "line")
    return staged(over.groupBy("host").agg(F.collect_list("line").alias("boilerplate")), "boilerplate")


def without_boilerplate(
    docs: DataFrame, host: str = "source", text: str = "text", *, percent: int = 10, min_pages: int = 1, others: bool = False, keep_copies: bool = False
) -> DataFrame:
    """``docs`` with the lines dropped that more than ``percent`` % of its host's pages contain; adds
    ``n_lines`` and ``n_dropped`` (long).

    Lines are compared without blanks at their ends; a page counts once however often it has a
    line, and a row that repeats a page counts as a page. Empty lines are kept. ``min_pages``: a
    line must also be on so many pages. With neither ``min_pages`` nor ``others`` a host of fewer
    than 100 / ``percent`` pages loses every line, as each is on that share of its pages. ``others``
    takes the share among a page's *other* pages, (pages - 1) / (total - 1): a host's only page
    keeps its lines, and one of two loses those that both have. ``keep_copies``: a page that has lines, all of them
    boilerplate, is a copy rather than a frame around something, and stays whole, for the operators
    on copies; else it is left with its empty lines. Null text stays null with 0 lines; null hosts
    form one host. The columns ``n_lines`` and ``n_dropped`` of the input are replaced, all others
    pass through, whatever their names. An empty table gives an empty one. The hosts' lists come
    back as a written table: Spark broadcasts it if its measured size is below its threshold and
    else splits hot hosts in a sort-merge join.
    """
    own = uuid.uuid4().hex
    owner, bad, kept = (f"{x}_{own}" for x in ("host", "bad", "kept"))
    found = boilerplate(docs, host, text, percent, min_pages, others).withColumnsRenamed({"host": owner, "boilerplate": bad})
    joined = docs.join(found, F.col(host).eqNullSafe(F.col(owner)), "left")
    lines = F.split(text, "\n")
    # one pass by hashing finds the page's own boilerplate; each line is looked up in that short list
    joined = joined.withColumn(bad, F.array_intersect(_keys(text), F.col(bad)))
    known = joined.withColumn(kept, F.filter(lines, lambda x: ~F.coalesce(F.array_contains(F.col(bad), _key(_line(x))), F.lit(False))))
    some = F.exists(kept, lambda x: _line(x) != "") if keep_copies else F.lit(True)
    known = known.withColumn(kept, F.when(F.col(bad).isNull() | ~some, lines).otherwise(F.col(kept)))
    count = lambda x: F.coalesce(F.when(x.isNotNull(), F.size(x)), F.lit(0)).cast("long")
    known = known.withColumns({"n_lines": count(lines), "n_dropped": count(lines) - count(F.col(kept))})
    return known.withColumn(text, F.array_join(kept, "\n")).drop(owner, bad, kept)
