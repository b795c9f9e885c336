"""Parser responses (JSON of any shape) as ordered elements and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names under which a box may hold its coordinates.
ARRAYS = ("coord", "bbox", "polygon", "rectangle", "box")
CORNERS = (("x0", "y0", "x1", "y1"), ("left", "top", "right", "bottom"), ("x_min", "y_min", "x_max", "y_max"))


def coordinates(box: Column) -> Column:
    """Left, top, right and bottom of an element's box, under whatever name; else null."""
    get = lambda key: F.try_variant_get(box, f"$.{key}", "double")
    found = [F.try_variant_get(box, f"$.{k}", "array<double>") for k in ARRAYS]
    found += [F.when(sum((get(k).isNotNull().cast("int") for k in ks), F.lit(0)) == 4, F.array(*map(get, ks))) for ks in CORNERS]
    return F.coalesce(*found)


def elements(responses: DataFrame, doc: str = "doc", response: str = "response") -> DataFrame:
    """The elements of each response in order; a response that can't be read has none.

    Types are in lower case; unknown ones are kept.
    """
    listed = F.try_variant_get(F.try_parse_json(response), "$.document.elements", "array<variant>")
    each = responses.select(F.col(doc).alias("doc"), F.posexplode(listed).alias("pos", "e")).withColumn("box", F.try_variant_get("e", "$.bbox[0]", "variant"))
    text = lambda key: F.try_variant_get("e", f"$.{key}", "string")
    return each.select(
        "doc", "pos", F.lower(F.coalesce(text("type"), F.lit(""))).alias("el_type"), text("content").alias("content"), text("description").alias("description"),
        F.try_variant_get("e", "$.confidence", "double").alias("confidence"), F.try_variant_get("box", "$.page_id", "int").alias("page"),
        coordinates(F.col("box")).alias("coord"),
    )


def pages(responses: DataFrame, doc: str = "doc", response: str = "response") -> DataFrame:
    """(doc, pos, page, image_uri) of each response, from its top level or its document."""
    parsed = F.try_parse_json(response)
    listed = F.coalesce(*[F.try_variant_get(parsed, p, "array<variant>") for p in ("$.pages", "$.document.pages")])
    each = responses.select(F.col(doc).alias("doc"), F.posexplode(listed).alias("pos", "p"))
    number = F.coalesce(F.try_variant_get("p", "$.id", "int"), F.try_variant_get("p", "$.page_id", "int"))
    return each.select("doc", "pos", number.alias("page"), F.try_variant_get("p", "$.image_uri", "string").alias("image_uri"))


def page_images(wanted: DataFrame, images: DataFrame, by_time: DataFrame | None = None) -> DataFrame:
    """``wanted`` (doc, page) with ``image_uri``: the image of its page number, else of the number before it, else by time of change.

    ``images`` (doc, pos, page, image_uri) lists pages; one without a number counts by its place, and
    of several with one number the first with an image is taken. ``by_time`` (doc, place, path) numbers
    image files from 0 and serves page ``place`` + 1 where no listed page does. A missing page number
    is looked up as 0. Every wanted row comes back once.
    """
    numbered = images.where("image_uri is not null").withColumn("_number", F.coalesce("page", "pos"))
    listed = numbered.groupBy(F.col("doc").alias("_doc"), "_number").agg(F.min_by("image_uri", F.struct(F.col("page").isNull(), "pos")).alias("_uri"))
    before = F.greatest(F.coalesce(F.col("page"), F.lit(1)) - 1, F.lit(0))
    own = wanted.columns
    chain = [(listed, F.col("page")), (listed, before)]
    if by_time is not None:
        files = by_time.groupBy(F.col("doc").alias("_doc"), F.col("place").alias("_number")).agg(F.min("path").alias("_uri"))
        chain.append((files, before))
    out = wanted
    for k, (table, number) in enumerate(chain):
        step = table.toDF(f"_doc{k}", f"_number{k}", f"_uri{k}")
        out = out.join(step, (F.col("doc") == F.col(f"_doc{k}")) & (number == F.col(f"_number{k}")), "left")
    return out.select(*own, F.coalesce(*[f"_uri{k}" for k in range(len(chain))]).alias("image_uri"))


#: Tags of web pages, and the element types that they stand for.
TAGS = {"title": "title", "h1": "section_header", "p": "text", "footer": "page_footer", "nav": "page_header"}


def page_elements(html: DataFrame, doc: str = "page_id", text: str = "html") -> DataFrame:
    """Elements of web pages by tag, natively: (doc, tag, n, el_type, content); n counts within a tag."""
    kinds = [F.struct(F.lit(t).alias("tag"), F.lit(k).alias("el_type"), F.regexp_extract_all(text, F.lit(rf"(?s)<{t}[^a-z>]*>(.*?)</{t}>"), F.lit(1)).alias("found")) for t, k in TAGS.items()]
    each = html.select(F.col(doc).alias("doc"), F.explode(F.array(*kinds)).alias("x"))
    return each.select("doc", "x.tag", "x.el_type", F.posexplode("x.found").alias("n", "raw")).select("doc", "tag", "n", "el_type", F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]+>", " "), r"\s+", " ")).alias("content"))
