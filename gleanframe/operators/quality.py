"""Grounding, review and what counts as a measure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import is_date
from ..functions.numbers import measure, numbers_in
from ..functions.text import comparable_value
from ..schemas import ESTIMATED, Settings

# Words that are values though not numbers, and words that mark a sentence.
CATEGORIES = ("n/a", "na", "nil", "none", "compliant", "non-compliant", "not applicable", "not reported", "exempt", "yes", "no", "pass", "fail", "true", "false", "-", "—")
SENTENCE_WORDS = ("the", "this", "that", "is", "are", "was", "were", "summarises", "summarizes", "shows", "includes", "provides", "and", "of", "for", "with", "report", "section", "overview", "summary")
GROUNDED, UNGROUNDED, NOT_APPLICABLE = "grounded", "ungrounded", "not_applicable"


def grounding(value: Column, source: Column, is_figure: Column) -> Column:
    """Whether the value's number, or else its text, occurs in the source; values of figures can't be told."""
    core = F.try_element_at(numbers_in(value), F.lit(1))
    found = F.when(core.isNotNull(), F.array_contains(numbers_in(source), core)).otherwise(F.lower(source).contains(F.lower(value)))
    return F.when(is_figure, NOT_APPLICABLE).when(found, GROUNDED).otherwise(UNGROUNDED)


def review_needed(confidence: Column, tier: Column, in_conflict: Column, settings: Settings = Settings()) -> Column:
    """Conflicts, and little confidence in what isn't an estimate anyway."""
    weak = F.coalesce(confidence < settings.review_threshold, F.lit(False)) & ~F.coalesce(tier == ESTIMATED, F.lit(False))
    return in_conflict | weak


def gated(claims: DataFrame, conflicts: DataFrame | None = None, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """(clean, review) claims; ``conflicts`` lists metrics (canonical_metric) that contradict each other."""
    marked = claims.withColumn("_conflict", F.lit(False))
    if conflicts is not None:
        names = conflicts.select("canonical_metric").distinct().withColumn("_hit", F.lit(True))
        marked = claims.join(names, "canonical_metric", "left").withColumn("_conflict", F.coalesce("_hit", F.lit(False))).drop("_hit")
    flagged = marked.withColumn("_review", review_needed(F.col("confidence"), F.col("citation_tier"), F.col("_conflict"), settings))
    reason = F.when(F.col("_conflict"), "conflict").otherwise("low_confidence")
    clean = flagged.where("not _review").drop("_review", "_conflict")
    return clean, flagged.where("_review").withColumn("review_reason", reason).drop("_review", "_conflict")


def is_measure(value: Column, field: Column) -> Column:
    """Whether a value belongs in the structured layer: a number, a date, a status, or a few words that are neither heading nor sentence."""
    text = F.trim(F.coalesce(value, F.lit("")))
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    capitals = F.size(F.filter(words, lambda w: w.rlike(r"^\p{Lu}")))
    told = F.exists(words, lambda w: F.lower(w).isin(*SENTENCE_WORDS))
    return (
        F.when(text == "", False).when(measure(text, field).isNotNull() | is_date(text), True).when(F.lower(text).isin(*CATEGORIES), True)
        .when((F.size(words) > 4) | (F.length(text) > 40), False).when((F.size(words) >= 2) & (capitals >= 2), False)
        .when((F.size(words) >= 3) & told, False).otherwise(True)
    )


def without_echoes(claims: DataFrame) -> DataFrame:
    """Claims but for estimates read from text, which repeat a figure."""
    return claims.where(~F.coalesce((F.col("citation_tier") == ESTIMATED) & (F.col("element_type") == "text"), F.lit(False)))


def without_repeats(vision: DataFrame, rules: DataFrame) -> DataFrame:
    """Vision claims whose value no rule-based claim of the same page has."""
    known = rules.select(F.col("doc").alias("_doc"), F.col("page").alias("_page"), comparable_value(F.col("value")).alias("_value")).distinct()
    same = (vision["doc"] == F.col("_doc")) & vision["page"].eqNullSafe(F.col("_page")) & (comparable_value(vision["value"]) == F.col("_value"))
    return vision.join(known, same, "left_anti")
