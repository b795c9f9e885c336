"""Layers of stored rows: stamps, hashes, idempotent appends, gold, review and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import date_of_file, date_within, is_date, is_date_field, report_date
from ..functions.numbers import measure
from ..functions.text import entity_or_unknown, short_hash, source_document
from . import batches
from .quality import is_measure

#: What a row's identity is made of, and the columns of a layer that aren't strings.
KEY = ("entity_ref", "source_document", "page", "canonical_metric", "value", "as_at_date")
TYPED = {"numeric_value": "double", "confidence": "double", "page": "bigint"}


def row_hash(*columns: Column) -> Column:
    """Hash of the values in order; null is the word ``None`` in every layer."""
    return short_hash(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("None")) for c in columns]))


def stamped(rows: DataFrame, values: dict[str, Column], key: tuple[str, ...] = KEY, at: Column | None = None) -> DataFrame:
    """Rows with the given columns, the time of extraction (ISO text, UTC) and their content hash."""
    named = rows.withColumns(values)
    made = at if at is not None else F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    return named.withColumn("extraction_date", made).withColumn("content_hash", row_hash(*[F.col(c) if c in named.columns else F.lit(None) for c in key]))


def typed(rows: DataFrame) -> DataFrame:
    """The fixed schema of stored rows: a few numbers, all else strings; what can't be a number is null."""
    nested = {f.name for f in rows.schema if f.dataType.typeName() in ("array", "struct", "map", "boolean")}
    return rows.select(*[F.col(c) if c in nested else F.col(c).try_cast(TYPED.get(c, "string")).alias(c) for c in rows.columns])


def first_of_each(rows: DataFrame, key: str = "content_hash", order: tuple[str, ...] = ("doc", "pos"), copies: bool = True) -> DataFrame:
    """The first row of each key. With many ``copies`` each task drops its own before rows are dealt, for which it sorts them; else rows are sorted once they are dealt."""
    w = Window.partitionBy(key).orderBy(*order)
    if copies:
        return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    return rows.withColumn("_before", F.lag(F.lit(1)).over(w)).where("_before is null").drop("_before")


def keyed(rows: DataFrame, key: str = "content_hash") -> DataFrame:
    """Rows without a key get the hash of their JSON."""
    own = short_hash(F.to_json(F.struct(*sorted(rows.columns))))
    return rows.withColumn(key, F.coalesce(key, own) if key in rows.columns else own)


def new_rows(rows: DataFrame, stored: DataFrame | None, key: str = "content_hash", order: tuple[str, ...] = ("doc", "pos"), copies: bool = True) -> DataFrame:
    """Rows whose key isn't stored yet, one for each key; rows without one get the hash of their JSON."""
    fresh = first_of_each(keyed(rows, key), key, order, copies)
    return fresh if stored is None else fresh.join(stored.select(key), key, "left_anti")


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a layer that committed batches wrote; None where there are none."""
    return batches.stored_rows(spark, path)


def append(rows: DataFrame, path: str, key: str = "content_hash", order: tuple[str, ...] = ("doc", "pos"), by: tuple[str, ...] = ("team", "report_type")) -> int:
    """Append the rows that a layer lacks as a batch of their own; returns their number. See ``batches.Batch.append``."""
    out, _, layer = path.rstrip("/").rpartition("/")
    with batches.Batch(rows.sparkSession, out) as batch:
        return batch.append(rows, layer, key, order, by)


def gold(claims: DataFrame) -> DataFrame:
    """Measures alone, with their number or date derived; the names of missing columns become nulls."""
    has = lambda c: F.col(c) if c in claims.columns else F.lit(None).cast("string")
    field = F.coalesce(F.nullif(has("canonical_metric"), F.lit("")), has("field_name"))
    kept = claims.where(is_measure(F.col("value"), field))
    dated = F.coalesce(F.nullif(has("as_at_date"), F.lit("")), F.when(is_date(F.col("value"), field), report_date(F.col("value"))))
    document = has("source_document") if "source_document" in claims.columns else source_document(has("source_element_id"))
    derived = {"canonical_metric": field, "entity_ref": entity_or_unknown(has("entity_ref")), "numeric_value": measure(F.col("value"), field), "as_at_date": dated, "source_document": document}
    return kept.withColumns(derived)


def analytical(rows: DataFrame) -> DataFrame:
    """The parts of a metric's path as columns."""
    part = lambda k: F.try_element_at(F.split("canonical_metric", r" \| "), F.lit(k))
    return rows.withColumns({n: part(k) for k, n in enumerate(("statement", "classification", "category", "sub_category"), 1)})


def checked(rows: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules, and the others with the first broken one as ``error``."""
    broken = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()])
    marked = rows.withColumn("error", broken)
    return marked.where("error is null").drop("error"), marked.where("error is not null")


def document_dates(documents: DataFrame, elements: DataFrame, claims: DataFrame) -> DataFrame:
    """(doc, report_date): from the file's name (``path``), else one of the first eight headings and texts, else a claim, a date's field first."""
    texts = elements.where(F.col("el_type").isin("title", "section_header", "text"))
    first = texts.withColumn("_n", F.row_number().over(Window.partitionBy("doc").orderBy("pos"))).where("_n <= 8")
    headed = first.withColumn("_date", date_within(F.col("content"))).where("_date is not null").groupBy("doc").agg(F.min_by("_date", "pos").alias("_head"))
    field = F.coalesce(F.nullif(F.col("canonical_metric"), F.lit("")), F.col("field_name"), F.lit(""))
    dated = claims.where(is_date(F.col("value"), field)).select("doc", report_date(F.col("value")).alias("_date"), F.struct((~is_date_field(field)).alias("late"), F.col("pos")).alias("_order"))
    claimed = dated.groupBy("doc").agg(F.min_by("_date", "_order").alias("_claim"))
    all_ = documents.join(headed, "doc", "left").join(claimed, "doc", "left")
    return all_.select("doc", F.coalesce(date_of_file(F.col("path")), "_head", "_claim").alias("report_date"))
