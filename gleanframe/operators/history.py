"""Rows in their order: places, neighbours, first and last of each kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def placed(rows: DataFrame, by: str, order: str, place: str = "place") -> DataFrame:
    """Rows with their place in the order of their group, from 0."""
    return rows.withColumn(place, F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1)


def neighbours(rows: DataFrame, by: str, order: str, column: str, **steps: int) -> DataFrame:
    """Rows with a column's value so many rows further on (before, if negative) in their group, by name; null beyond its ends."""
    w = Window.partitionBy(by).orderBy(order)
    return rows.withColumns({name: F.lead(column, n).over(w) if n >= 0 else F.lag(column, -n).over(w) for name, n in steps.items()})


def picked(rows: DataFrame, by: list[str], order: Column, last: bool = False) -> DataFrame:
    """The first row of each group in an order, or the last; each task sends one row a group."""
    whole = F.struct(*[F.col(c).alias(c) for c in rows.columns])
    pick = F.max_by if last else F.min_by
    return rows.groupBy(*by).agg(pick(whole, order).alias("_row")).select("_row.*")


def ends_of_kind(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows marked as the first and the last of their group."""
    w = Window.partitionBy(*by)
    return rows.withColumns({"first_of_kind": F.col(order) == F.min(order).over(w), "last_of_kind": F.col(order) == F.max(order).over(w)})
