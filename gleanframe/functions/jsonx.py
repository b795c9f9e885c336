"""Tolerant reading of JSON that a model wrote."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Keys under which a tool call may hold its points, in order.
POINT_KEYS = ("claims", "metrics", "points", "data", "values")


def _objects(json: Column) -> Column:
    """The objects of a JSON array as strings; null if it isn't one."""
    items = F.from_json(json, "array<variant>")
    return F.transform(F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT")), lambda v: F.to_json(v))


def is_array(json: Column) -> Column:
    return F.coalesce(F.schema_of_variant(F.try_parse_json(json)).startswith("ARRAY"), F.lit(False))


def points_in(text: Column) -> Column:
    """The objects of the JSON array that a text is or contains from its first ``[`` to its last ``]``; else none."""
    inner = F.regexp_extract(text, r"(?s)\[.*\]", 0)
    whole = F.when(is_array(text), _objects(text)).when(is_array(inner), _objects(inner))
    return F.coalesce(whole, F.array().cast("array<string>"))


def points_of_call(arguments: Column) -> Column:
    """The objects under the first known key that holds an array; without one, the arguments themselves."""
    out = F.when(F.coalesce(F.trim(arguments), F.lit("")).isin("", "{}"), F.array().cast("array<string>"))
    for key in POINT_KEYS:
        held = F.get_json_object(arguments, f"$.{key}")
        out = out.when(is_array(held), _objects(held))
    return out.otherwise(F.array(arguments))


def embedded_arguments(text: Column) -> Column:
    """The first object with claims inside a text, from its first brace to its last."""
    inner = F.regexp_extract(text, r'(?s)\{.*"claims".*\}', 0)
    return F.when(F.try_parse_json(text).isNotNull() & text.startswith("{"), text).when(F.try_parse_json(F.nullif(inner, F.lit(""))).isNotNull(), inner)
