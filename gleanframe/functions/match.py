"""Fuzzy matching of fields and values against the truth, and of firms against entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import VALUE_MARKS, comparable_value

#: Share of the truth's words that a field must have, and the tolerance of values read from charts.
WORD_SHARE, CHART_TOLERANCE = 0.6, 0.03
CHART_TYPES = ("figure", "chart")
#: Characters of the stretches by which contained texts are found.
GRAM = 3


def field_words(text: Column) -> Column:
    words = F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9 ]", " "), " +")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def field_matches(wanted: Column, found: Column) -> Column:
    """Whether most words of the wanted label occur in the found one; an empty label always matches."""
    words = field_words(wanted)
    shared = F.size(F.array_intersect(words, field_words(found)))
    return (F.size(words) == 0) | (shared >= F.greatest(F.lit(1), F.floor(F.size(words) * WORD_SHARE + 0.5)))


def as_number(value: Column) -> Column:
    return F.regexp_replace(value, VALUE_MARKS, "").try_cast("double")


def within(a: Column, b: Column, tolerance: float) -> Column:
    """Whether ``a`` is within a relative tolerance of ``b``."""
    return F.coalesce(F.when(b != 0, F.abs(a - b) / F.abs(b) <= tolerance), F.lit(False))


def value_matches(found: Column, truth: Column, kind: Column, tolerance: float = CHART_TOLERANCE) -> Column:
    """Equal after normalisation or, for charts, within the tolerance of the truth."""
    near = kind.isin(*CHART_TYPES) & within(as_number(found), as_number(truth), tolerance)
    return (comparable_value(found) == comparable_value(truth)) | F.coalesce(near, F.lit(False))


def grams(text: Column, size: int) -> Column:
    """The distinct stretches of ``size`` characters of a text."""
    n = F.char_length(text) - size + 1
    return F.when(n > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), n), lambda k: F.substring(text, k, F.lit(size))))).otherwise(F.array().cast("array<string>"))


def containing(outer: DataFrame, inner: DataFrame, a: str, b: str) -> DataFrame:
    """Pairs (a, b) of distinct texts of which ``a`` contains ``b``; empty texts are in none.

    An inner text is looked up by the rarest of its stretches of ``GRAM`` characters among the outer
    ones (a shorter text by itself), and what is found is verified. One whose rarest stretch is
    nowhere has no pair.
    """
    long, short = outer.select(a).where(F.col(a) != "").distinct(), inner.select(b).where(F.col(b) != "").distinct()
    sizes = F.array(*[F.struct(F.lit(k).alias("size"), grams(F.col(a), k).alias("found")) for k in range(1, GRAM + 1)])
    spread = long.select(a, F.explode(sizes).alias("_s")).select(a, F.explode("_s.found").alias("_gram"))
    size = F.least(F.char_length(F.col(b)), F.lit(GRAM))
    own = F.when(size < GRAM, F.array(b)).otherwise(grams(F.col(b), GRAM))
    asked = short.select(b, F.explode(own).alias("_gram")).join(spread.groupBy("_gram").agg(F.count("*").alias("_n")), "_gram", "left")
    rarest = asked.groupBy(b).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_gram")).alias("_x")).where("_x.n > 0").select(b, F.col("_x._gram").alias("_gram"))
    return spread.join(rarest, "_gram").where(F.col(a).contains(F.col(b))).select(a, b)


def with_firm(rows: DataFrame, entity: str, firms: DataFrame, name: str = "firm", order: str = "position") -> DataFrame:
    """``rows`` with the settings of the first firm whose name contains the entity's or is contained in it.

    Case and spaces don't count. ``firms`` (name, position, settings) may be of any number. Rows
    without a firm, and those whose entity has no letters left, keep nulls.
    """
    key = lambda c: F.replace(F.lower(c), F.lit(" "), F.lit(""))
    entities = rows.select(F.col(entity).alias("_entity")).distinct().withColumn("_ours", key(F.col("_entity")))
    keyed = firms.withColumn("_key", key(F.col(name)))
    both = containing(entities, keyed, "_ours", "_key").unionByName(containing(keyed, entities, "_key", "_ours")).distinct()
    named = entities.join(both, "_ours").join(keyed, "_key")
    first = F.row_number().over(Window.partitionBy("_entity").orderBy(order, name))
    chosen = named.withColumn("_n", first).where("_n = 1").drop("_n", "_key", "_ours")
    return rows.join(chosen, rows[entity] == chosen["_entity"], "left").drop("_entity")
