"""Values in prose and in figures' descriptions, named by the words before them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined_context, last_words, squeezed, unit_of
from ..schemas import ESTIMATED, PARSED

# A value with a currency or unit (the first alternative that fits wins), words
# between a label and its value, and words that end an introduction.
# A number is taken whole and looked for from its first digit alone: shorter or later ones end alike.
VALUE = r"(?:[£$€]\s?+\d[\d,]*+(?:\.\d++)?+\s?+(?:m|bn|k|bps|%)?|(?<!\d)\d[\d,]*+(?:\.\d++)?+\s?+(?:m|bn|k|bps|%|million|billion))"
FILLERS = r"(?=[aoiwrpct=:])\b(?:at|of|is|was|are|reached|reaching|peaking|approximately|approx|about|around|roughly|circa|=|:|to)\b"
INTRODUCTION = r"^.*\b(?:shows?|shown|following|below|are)\b[:\s]*"
TITLED = r"(?i)titled\s+['\"]([^'\"]+)['\"]"
_UNITS = ("%", "bps", "m", "bn", "k", "million", "billion")
_OPEN, _CLOSE = "\u0001", "\u0002"


def value_spans(text: Column, kept: Callable[[Column], Column], enough: Callable[[Column], Column]) -> Column:
    """(value, before, n) of each value in a text: values are fenced by marks and the text is cut at them.

    ``kept`` reduces the text before a value to what can still matter, ``enough`` tells of the text
    since the last value that nothing before it can. Where that holds between all values of a text,
    each has that text, to be reduced; else the parts are folded, so that work and memory grow with
    the text alone. The cut text is bound as the one element of an array: the optimizer would have
    it computed again for each value.
    """
    clean = F.replace(F.replace(text, F.lit(_OPEN), F.lit(" ")), F.lit(_CLOSE), F.lit(" "))
    parts = F.split(F.regexp_replace(clean, f"(?iU){VALUE}", f"{_OPEN}$0{_CLOSE}"), _OPEN)
    none = F.array().cast("array<struct<value: string, before: string, n: int>>")
    value = lambda part: F.substring_index(part, _CLOSE, 1)
    # with the last character of the value, on which a word's edge may depend
    since = lambda part: F.concat(F.right(value(part), F.lit(1)), F.substring_index(part, _CLOSE, -1))
    later = lambda p: F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0)))

    def step(done: Column, part: Column) -> Column:
        span = F.struct(value(part).alias("value"), done["before"].alias("before"), (F.size(done["spans"]) + 1).alias("n"))
        return F.struct(kept(F.concat(done["before"], F.replace(part, F.lit(_CLOSE), F.lit("")))).alias("before"), F.array_append(done["spans"], span).alias("spans"))

    def folded(p: Column) -> Column:
        return F.aggregate(later(p), F.struct(kept(p[0]).alias("before"), none.alias("spans")), step, lambda x: x["spans"])

    def alone(p: Column) -> Column:
        return F.transform(later(p), lambda part, k: F.struct(value(part).alias("value"), F.when(k == 0, p[0]).otherwise(since(p[k])).alias("before"), (k + 1).alias("n")))

    between = lambda p: F.slice(p, 2, F.greatest(F.size(p) - 2, F.lit(0)))
    spans = lambda p: F.when(F.forall(between(p), lambda x: enough(since(x))), alone(p)).otherwise(folded(p))
    return F.element_at(F.transform(F.array(parts), spans), 1)


def _last_pieces(words: int) -> Callable[[Column], Column]:
    """The end of a text that holds its last words, cut at single spaces."""
    return lambda before: F.substring_index(before, " ", -(words + 2))


def _has_pieces(words: int) -> Callable[[Column], Column]:
    """Whether a text has so many single spaces that its last words are in it."""
    return lambda text: F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) >= words + 2


_MARK = r"(?i),(?=.)|;(?=.)|\band\b(?=.)"


def _last_clause(before: Column) -> Column:
    """The text behind the last clause mark that something follows."""
    return F.regexp_replace(before, rf"(?i)^.*(?:{_MARK.removeprefix('(?i)')})", "")  # unlike split, it compiles the pattern once


def prose_values(rows: DataFrame, text: str = "content", title: str | None = None, words: int = 6) -> DataFrame:
    """A row for each value with currency or unit; its name is the last words before it. Values without any are skipped."""
    kept = _last_pieces(words)
    each = rows.withColumn("_span", F.explode(value_spans(squeezed(F.col(text)), kept, _has_pieces(words))))
    named = _bound(each, last_words(kept(F.col("_span.before")), words)).where("_named.field_name <> ''")
    name = joined_context(F.col(title), F.col("_named.field_name")) if title else F.col("_named.field_name")
    out = named.withColumns({"field_name": name, "n": F.col("_span.n"), "value": F.col("_named.value"), "unit": F.col("_named.unit"), "element_type": F.lit("text"), "confidence": F.lit(0.7), "citation_tier": F.lit(PARSED)})
    return out.withColumn("canonical_metric", F.col("field_name")).drop("_span", "_named")


def _bound(each: DataFrame, label: Column) -> DataFrame:
    """Adds ``_named`` (field_name, value, unit) of a span, as a generated column: the optimizer would compute the label again wherever it is used."""
    value = squeezed(F.col("_span.value"))
    return each.withColumn("_named", F.explode(F.array(F.struct(label.alias("field_name"), value.alias("value"), _unit(value).alias("unit")))))


def _unit(value: Column) -> Column:
    """``unit_of`` a value as ``VALUE`` finds it: told by its ends, without looking for tokens, where these are in lower case."""
    sign, last = F.left(value, F.lit(1)), F.coalesce(*[F.when(value.endswith(u), F.lit(u)) for u in _UNITS])
    money = F.when(last.isin("m", "bn", "k"), F.concat(sign, last)).when(last.isin("%", "bps") | F.right(value, F.lit(1)).between("0", "9"), sign)
    return F.coalesce(F.when(sign.isin("£", "$", "€"), money).otherwise(last), unit_of(value))


def figure_label(before: Column, words: int = 4) -> Column:
    """The label in the text before a value: its last clause without fillers and introduction."""
    after = F.substring_index(F.substring_index(before, ",", -1), ";", -1)
    clause = F.when(F.lower(after).contains("and"), F.regexp_replace(after, r"(?i)^.*\band\b", "")).otherwise(after)
    plain = F.regexp_replace(F.regexp_replace(clause, f"(?i){FILLERS}", " "), f"(?im){INTRODUCTION}", "")
    return last_words(plain, words)


def figure_values(rows: DataFrame, text: str = "description", title: str | None = None) -> DataFrame:
    """A row for each value of a figure's description, named by the chart's title and the label before it."""
    clean = squeezed(F.col(text))
    own = lambda c: F.trim(F.regexp_extract(c, TITLED, 1))
    found = lambda c: F.struct(own(c).alias("chart"), value_spans(c, _last_clause, lambda x: x.rlike(_MARK)).alias("spans"))
    # once a text, before its values are rows; a column beside the generator would be computed for each of them
    each = rows.withColumn("_found", F.explode(F.transform(F.array(clean), found))).withColumn("_span", F.explode("_found.spans"))
    named = _bound(each, figure_label(F.col("_span.before"))).where("_named.field_name <> ''")
    name = joined_context(*([F.col(title)] if title else []), F.col("_found.chart"), F.col("_named.field_name"))
    out = named.withColumns({"field_name": F.col("_named.field_name"), "n": F.col("_span.n"), "canonical_metric": name, "value": F.col("_named.value"), "unit": F.col("_named.unit"), "element_type": F.lit("text"), "confidence": F.lit(0.75), "citation_tier": F.lit(ESTIMATED)})
    return out.drop("_span", "_found", "_named")
