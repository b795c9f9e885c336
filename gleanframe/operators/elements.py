"""Routing of elements, and the headings above them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import has_number
from ..functions.text import is_ornament, joined_context, squeezed, untagged
from ..schemas import HEADINGS, LAYOUT, Settings


def is_layout(kind: Column) -> Column:
    return kind.isin(*LAYOUT)


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) == ""


def figure_class(description: Column, content: Column) -> Column:
    """``logo``, ``no_content`` or, where description or content holds a number, ``data``."""
    text = F.concat_ws(" ", description, content)
    return F.when(is_ornament(description, content), "logo").when(has_number(text), "data").otherwise("no_content")


def needs_image(kind: Column, content: Column, confidence: Column, settings: Settings = Settings()) -> Column:
    """Figures that are blank or read with little confidence."""
    return F.coalesce((kind == "figure") & (_blank(content) | F.coalesce(confidence < settings.figure_threshold, F.lit(False))), F.lit(False))


# Routes: ``as_parsed`` takes the parser's output, ``read_image`` has a model read the picture, ``read_text`` the description.
def table_route(kind: Column, content: Column, confidence: Column, settings: Settings = Settings()) -> Column:
    weak = _blank(content) | F.coalesce(confidence < settings.table_threshold, F.lit(False))
    return F.when((kind == "table") & weak, "read_image").otherwise("as_parsed")


def figure_route(description: Column, content: Column, confidence: Column, settings: Settings = Settings()) -> Column:
    kind = figure_class(description, content)
    image = (kind == "no_content") | F.coalesce(confidence < settings.figure_threshold, F.lit(False))
    return F.when(kind == "logo", "skip").when(image, "read_image").otherwise("read_text")


def route(kind: Column) -> Column:
    """What becomes of an element: layout is skipped, headings give context, others are extracted by kind."""
    named = F.when(is_layout(kind), "skip").when(kind.isin(*HEADINGS), "context")
    return named.when(kind.isin("table", "figure", "caption", "footnote", "text"), kind).otherwise("other")


def with_context(elements: DataFrame) -> DataFrame:
    """Elements with the title and section above them on their page.

    Both are forgotten where a page number differs from the last one given; elements without a page
    belong to the page before. A new title leaves the section. One shuffle by document serves all.
    """
    upto = Window.partitionBy("doc").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    paged = elements.where(~is_layout(F.col("el_type"))).withColumn("_page", F.last("page", ignorenulls=True).over(upto))
    turned = F.when(F.col("_page").eqNullSafe(F.lag("_page").over(Window.partitionBy("doc").orderBy("pos"))), 0).otherwise(1)
    parts = paged.withColumn("_turned", turned).withColumn("_part", F.sum("_turned").over(upto))
    inside = Window.partitionBy("doc", "_part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    heading = lambda kind: F.last(F.when(F.col("el_type") == kind, F.nullif(squeezed(untagged(F.col("content"))), F.lit(""))), ignorenulls=True).over(inside)
    out = parts.withColumns({"title": heading("title"), "section": heading("section_header")})
    return out.withColumn("context", joined_context(F.col("title"), F.col("section"))).withColumnRenamed("_part", "segment").drop("_page", "_turned")


def hybrid_split(elements: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Elements that are used as parsed, and figures that need their image read."""
    test = needs_image(F.col("el_type"), F.col("content"), F.col("confidence"), settings)
    return elements.where(~test), elements.where(test)
