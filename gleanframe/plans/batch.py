"""A whole batch: files to elements, claims, layers and chunks, as one plan with several sinks."""

from __future__ import annotations

from collections.abc import Awaitable, Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import jsonx
from ..functions.text import entity_or_unknown, is_ornament
from ..operators import batches, charts, evaluate, layers, prose, quality, tables
from ..operators import chunks as ch
from ..operators import elements as el
from ..schemas import Settings
from ..sources import files, parsed, providers, rawpages

#: What a batch writes.
LAYERS = ("bronze", "silver", "gold", "review", "quarantine", "audit", "pages", "chunks")
CLAIM_COLUMNS = ("doc", "pos", "page", "element_type", "field_name", "canonical_metric", "value", "unit", "confidence", "citation_tier", "content")


def _keyed(elements: DataFrame) -> DataFrame:
    return elements.where("el_type = 'table'").withColumn("key", F.concat_ws("\u0001", "doc", F.col("pos").cast("string")))


def claims_of(elements: DataFrame, vision: DataFrame | None = None, read_tables: DataFrame | None = None) -> DataFrame:
    """Claims of all elements by route: tables by their cells (``read_tables``, if they are read already) or, without any number in it, as a whole; prose and captions by their values; figures by what a model read (``vision``) or else by their description."""
    known = el.with_context(elements)
    text = known.where(F.col("el_type").isin("text", "caption", "footnote"))
    keyed = _keyed(known)
    found = tables.table_claims(keyed, "key", "content", "context", read_tables)
    place = keyed.select("key", "doc", "pos", "page", "content")
    table = found.join(place, "key")
    whole = tables.whole_table_claims(keyed, found, "key", "content").withColumns({
        "canonical_metric": F.col("field_name"), "unit": F.lit(None).cast("string"), "element_type": F.lit("table"), "citation_tier": F.lit("parsed"),
    }).join(place, "key")
    figure = prose.figure_values(known.where((F.col("el_type") == "figure") & (el.figure_class(F.col("description"), F.col("content")) == "data")), "description", "context").select(*CLAIM_COLUMNS)
    if vision is not None:
        figure = charts.or_described(vision.select(*CLAIM_COLUMNS), figure)
    parts = [table, whole, prose.prose_values(text, "content", "context"), figure]
    out = parts[0].select(*CLAIM_COLUMNS)
    for x in parts[1:]:
        out = out.unionByName(x.select(*CLAIM_COLUMNS))
    return out


def vision_claims(elements: DataFrame, readings: DataFrame) -> DataFrame:
    """Claims of the figures that a model read: (doc, pos, raw, error) to one row for each point with a name and a value."""
    points = readings.where("raw is not null").select("doc", "pos", F.explode(jsonx.points_in(F.col("raw"))).alias("point"))
    place = elements.select("doc", "pos", "page", "content")
    return charts.points_to_claims(points).join(place, ["doc", "pos"]).select(*CLAIM_COLUMNS)


def run_batch(
    spark: SparkSession, root: str, out: str, parse: Callable[..., str] = providers.as_json, settings: Settings = Settings(), limit: int | None = None,
    read: Callable[[dict], Awaitable[str]] | None = None, **how,
) -> dict[str, int]:
    """Ingest all submissions below ``root`` into layers below ``out``; returns rows added by layer. Running twice adds nothing, and asks no provider. See ``process``."""
    return process(files.submissions(spark, root, limit), out, parse, settings, read, **how)


def process(
    found: DataFrame, out: str, parse: Callable[..., str] = providers.as_json, settings: Settings = Settings(), read: Callable[[dict], Awaitable[str]] | None = None,
    *, id: str | None = None, options: dict | None = None, retry_failed: bool = False, images: DataFrame | None = None,
) -> dict[str, int]:
    """Ingest ``found`` (path, content, team, report_type, entity_ref, entity_id, entity_name) into layers below ``out``; returns rows added by layer.

    ``bronze`` has the elements, ``silver`` all claims, ``gold`` the measures, ``review`` the flagged
    claims with a reason, ``audit`` what each document covers, ``chunks`` the readable text with
    tables as Markdown and figures with their claims, ``pages`` the page counts of the raw files;
    they become visible together, and a batch whose ``id`` is committed adds nothing. ``read`` (a
    model) gets each figure that needs its picture read, with the image of its page, if the parser
    gave one, or else of its place among ``images`` (doc, place, path). All answers of parser and
    model stay in the ledger ``answers``. One bad document doesn't fail the batch: it becomes a
    quarantine row. Elements, tables and claims are written once and read by all that needs them.
    """
    spark = found.sparkSession
    with batches.Batch(spark, out, id) as batch:
        if batch.done:
            return dict.fromkeys(LAYERS, 0)
        responses = batch.written(providers.parsed_by(found, parse, f"{out}/answers", options, retry_failed), "responses")
        elements = batch.written(parsed.elements(responses), "elements")
        vision = None
        if read is not None:
            used, figures = el.hybrid_split(elements, settings)
            wanted = parsed.page_images(figures.select("doc", "pos", "page", "description"), parsed.pages(responses), images)
            wanted = wanted.join(responses.select("doc", "digest"), "doc")
            vision = vision_claims(elements, batch.written(providers.read_by_model(wanted, read, f"{out}/answers", options=options, retry_failed=retry_failed), "readings"))
        read_tables = batch.written(tables.read_tables(_keyed(elements), "key", "content"), "tables")
        claims = batch.written(claims_of(elements, vision, read_tables), "claims")
        origin = batch.written(found.select(F.col("path").alias("doc"), "team", "report_type", "entity_ref", "entity_id", "entity_name"), "origin")
        dates = layers.document_dates(origin.select("doc", F.col("doc").alias("path")), elements, claims)
        full = claims.join(origin, "doc").join(dates, "doc", "left").withColumns({
            "source_document": F.element_at(F.split("doc", "/"), -1), "entity_ref": entity_or_unknown(F.col("entity_ref")),
            "grounding": quality.grounding(F.col("value"), F.coalesce("content", F.lit("")), F.col("element_type") == "figure"), "as_at_date": F.lit(None).cast("string"),
        }).drop("content")
        silver = batch.written(layers.stamped(full, {}), "stamped")
        clean, review = quality.gated(silver, None, settings)
        whose = ["doc", "team", "report_type"]
        lost = responses.join(elements.select("doc").distinct(), "doc", "left_anti").join(origin, "doc").withColumns({"pos": F.lit(0), "error": F.coalesce("error", F.lit("no elements"))}).select(*whose, "pos", "error")
        bronze = elements.join(origin.select(*whose), "doc")
        audit = evaluate.coverage_audit(elements.withColumn("ornament", is_ornament(F.col("description"), F.col("content"))), claims).join(origin.select(*whose), "doc").withColumn("pos", F.lit(0))
        rendered = tables.markdown(_keyed(elements), "key", "content", read_tables).join(_keyed(elements).select("key", "doc", "pos"), "key")
        readable = ch.readable(elements, rendered, claims.where("citation_tier = 'llm_estimated'").select("doc", "page", "pos", "field_name", "canonical_metric", "value", "unit"))
        indexed = ch.chunks(readable.join(origin.select(*whose), "doc"), carried=("team", "report_type"))
        raw = rawpages.page_counts(found).withColumnRenamed("path", "doc").join(origin.select(*whose), "doc").withColumn("pos", F.lit(0))
        hashed = lambda df, *c: df.withColumn("content_hash", layers.row_hash(F.col("doc"), *[F.col(x) for x in c]))
        made = {
            "bronze": hashed(bronze, "pos", "el_type", "content", "description"), "silver": silver, "gold": layers.gold(clean), "review": review, "quarantine": hashed(lost, "error"),
            "audit": hashed(audit, "elements_total", "elements_accounted", "claims_total"), "pages": hashed(raw.where("total_pages is not null"), "total_pages"),
        }
        added = {layer: batch.append(rows, layer) for layer, rows in made.items()}
        return added | {"chunks": batch.append(indexed, "chunks", "chunk_id", ("source_document_id", "page"))}


def batch_totals(spark: SparkSession, out: str) -> DataFrame:
    """One row for a batch's layers below ``out``: documents, pages, claims, gold, review, quarantined, indexed."""
    counts = {"bronze": {"elements": F.count("*"), "documents": F.countDistinct("doc"), "pages": F.countDistinct("doc", "page")}}
    counts |= {layer: {name: F.count("*")} for layer, name in (("silver", "claims"), ("gold", "gold"), ("review", "review"), ("quarantine", "quarantined"), ("chunks", "indexed"))}
    rows = spark.createDataFrame([(name, 0) for c in counts.values() for name in c], "metric string, n long")
    for layer, wanted in counts.items():
        stored = layers.stored_rows(spark, f"{out}/{layer}")
        if stored is not None:
            one = stored.agg(*[c.alias(name) for name, c in wanted.items()])
            rows = rows.unionByName(one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("metric"), F.col(name).alias("n")) for name in wanted])).alias("x")).select("x.*"))
    return rows.groupBy().pivot("metric", [name for c in counts.values() for name in c]).agg(F.max("n"))


def run_metrics(totals: DataFrame, run: str, sink: Callable[[str, dict[str, float]], None] | None = None) -> DataFrame:
    """(run, metric, value) of a one-row table's numbers; ``sink`` (a tracker's callable) also gets them, if given."""
    numbers = [f.name for f in totals.schema if f.dataType.typeName() in ("integer", "long", "double", "float", "short", "byte")]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in numbers])
    out = totals.select(F.lit(run).alias("run"), F.explode(pairs).alias("x")).select("run", "x.*").where("value is not null")
    if sink is not None:
        sink(run, {r["metric"]: r["value"] for r in out.collect()})  # a row for each measure
    return out
