"""Text and hash functions: Column in, Column out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Sentinel for claims without an entity.
UNKNOWN_ENTITY = "UNKNOWN_ENTITY_REF"
# Marks that values are compared without, file types of documents, words that mark
# an ornament, separator of context parts, unit tokens.
VALUE_MARKS = r"[,£$€%\s]"
DOCUMENT_TYPES = r"\.(pptx|pdf|docx|xlsx)$"
ORNAMENTS = "(?i)logo|emblem|icon|crest|letterhead"
PART = " | "
UNIT = r"(?iU)(£|\$|€|%|bps|bn|m\b|k\b|million|billion)"


def short_hash(c: Column) -> Column:
    """First 16 hex digits of the SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def squeezed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def untagged(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", " ")


def _given(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def joined_context(*parts: Column) -> Column:
    """The parts that aren't empty, joined; null if there are none."""
    return _given(F.concat_ws(PART, *map(_given, parts)))


def source_document(element_id: Column) -> Column:
    """The document part of an element id, before its first locator."""
    head = F.element_at(F.split(element_id, r"-(?:s\d+-|p\d+-)?(?:img|fig|tbl|p)\d+"), 1)
    return F.when(element_id.isNull() | (element_id == ""), None).otherwise(F.coalesce(_given(head), element_id))


def entity_or_unknown(c: Column) -> Column:
    return F.coalesce(_given(c), F.lit(UNKNOWN_ENTITY))


def comparable_value(c: Column) -> Column:
    """A value without case, thousands separators, currency and percent signs and spaces."""
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), VALUE_MARKS, "")


def comparable_document(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(F.coalesce(c, F.lit("")))), DOCUMENT_TYPES, "")


def unit_of(c: Column) -> Column:
    """Currency with scale, else scale, else per cent or basis points, else the first unit token; null without any."""
    def first(found: Column) -> Column:
        pick = lambda a, wanted: F.coalesce(F.try_element_at(F.filter(a, lambda x: x.isin(wanted)), F.lit(1)), F.lit(""))
        low = F.transform(found, lambda x: F.lower(x))
        money = F.concat(pick(found, ["£", "$", "€"]), pick(low, ["m", "bn", "k", "million", "billion"]))
        return F.coalesce(F.nullif(money, F.lit("")), _given(pick(found, ["%", "bps"])), F.try_element_at(found, F.lit(1)))

    # the tokens are bound as the one element of an array: they are looked for once
    return F.element_at(F.transform(F.array(F.regexp_extract_all(c, F.lit(UNIT), F.lit(1))), first), 1)


def is_ornament(description: Column, content: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(description, F.lit("")), F.coalesce(content, F.lit(""))).rlike(ORNAMENTS)


def chunk_id(path: Column, page: Column, content: Column) -> Column:
    """Hash of path, page (``None`` if null) and the first 40 characters."""
    return short_hash(F.concat(path, F.lit("-"), F.coalesce(page.cast("string"), F.lit("None")), F.lit("-"), F.substring(content, 1, 40)))


def last_words(text: Column, k: int) -> Column:
    """The last ``k`` words, joined by spaces."""
    return F.substring_index(F.trim(F.regexp_replace(text, r"(?U)\s+", " ")), " ", -k)


def storage_path(c: Column, scheme: str = "store:", volumes: str = "/volumes", mounted: str = "/store") -> Column:
    """Paths below ``volumes`` without their scheme, others of the scheme below the folder where it is mounted; empty is null."""
    plain = F.substring(c, len(scheme) + 1, 1 << 30)
    return _given(F.when(c.startswith(scheme + volumes), plain).when(c.startswith(scheme), F.concat(F.lit(mounted), plain)).otherwise(c))
