"""Readable chunks for search, and search by cosine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import chunk_id, short_hash
from .elements import is_layout

#: A chunk has so many characters at least.
LEAST = 3


def readable(elements: DataFrame, rendered: DataFrame | None = None, figure_claims: DataFrame | None = None) -> DataFrame:
    """Elements with ``text``: tables as Markdown (rendered: doc, pos, markdown), figures as lines of their page's claims, else as they are."""
    df = elements
    if rendered is not None:
        df = df.join(rendered.select("doc", "pos", "markdown"), ["doc", "pos"], "left")
    else:
        df = df.withColumn("markdown", F.lit(None).cast("string"))
    if figure_claims is not None:
        line = F.concat(F.coalesce(F.nullif(F.col("field_name"), F.lit("")), F.col("canonical_metric")), F.lit(" = "), F.col("value"), F.coalesce(F.concat(F.lit(" "), F.nullif(F.col("unit"), F.lit(""))), F.lit("")))
        listed = figure_claims.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("_lines"))
        listed = listed.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), "_lines")
        df = df.join(listed, (F.col("doc") == F.col("_doc")) & F.col("page").eqNullSafe(F.col("_page")), "left").drop("_doc", "_page")
    else:
        df = df.withColumn("_lines", F.lit(None).cast("array<struct<pos int, line string>>"))
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    chart = F.concat(F.trim(F.coalesce(given("description"), F.lit("Chart"))), F.lit("\n"), F.array_join(F.transform("_lines", lambda x: x["line"]), "\n"))
    text = (
        F.when(F.col("el_type") == "table", F.coalesce(given("markdown"), F.col("content")))
        .when((F.col("el_type") == "figure") & F.col("_lines").isNotNull(), chart).when(F.col("el_type") == "figure", F.coalesce(given("description"), F.col("content")))
        .otherwise(F.coalesce(given("content"), F.col("description")))
    )
    return df.withColumn("text", F.trim(F.coalesce(text, F.lit("")))).drop("markdown", "_lines")


def admissible(kind: Column, text: Column) -> Column:
    return ~is_layout(kind) & (F.length(F.trim(F.coalesce(text, F.lit("")))) >= LEAST)


def chunks(readable_elements: DataFrame, path: str = "doc", carried: tuple[str, ...] = ()) -> DataFrame:
    """Chunk rows of the admissible elements, with id, hash and a map of what they measure; ``carried`` columns pass through."""
    kept = readable_elements.where(admissible(F.col("el_type"), F.col("text")))
    measures = F.map_filter(F.create_map(F.lit("page"), F.col("page").cast("string"), F.lit("element_type"), F.col("el_type")), lambda k, v: v.isNotNull())
    return kept.select(
        chunk_id(F.col(path), F.col("page"), F.col("text")).alias("chunk_id"), F.lit("raw_text").alias("chunk_type"), F.col("text").alias("content"),
        F.element_at(F.split(path, "/"), -1).alias("source_document_id"), short_hash(F.col("text")).alias("content_hash"), "page", F.lit("1.0").alias("schema_version"), measures.alias("metrics"), *carried,
    )


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def top_matches(vectors: DataFrame, query: list[float], k: int, vector: str = "embedding", id: str = "vec_id") -> DataFrame:
    """The ``k`` rows of the greatest cosine with the query; ties by id. Each task keeps k rows."""
    wanted = F.array(*[F.lit(float(x)) for x in query])
    return vectors.withColumn("score", cosine(F.col(vector), wanted)).orderBy(F.desc("score"), id).limit(k)
