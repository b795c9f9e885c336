"""Questions: to rows or to search, and the filters on rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words that ask for figures.
STRUCTURED_WORDS = r"(?i)\b(?:total|trend|how much)\b|over \d+ years"


def question_route(question: Column) -> Column:
    return F.when(F.coalesce(question, F.lit("")).rlike(STRUCTURED_WORDS), "structured").otherwise("narrative")


def filtered(gold: DataFrame, team: str | None = None, report_type: str | None = None, source_document: str | None = None, entity: str | None = None) -> DataFrame:
    """Rows of the given team, report type, document and entity; on a layer in folders, team and report type choose the folders."""
    wanted = {"team": team, "report_type": report_type, "source_document": source_document, "entity_ref": entity}
    return reduce(lambda df, kv: df.where(F.col(kv[0]) == kv[1]) if kv[1] is not None else df, wanted.items(), gold)


def united(tables: list[DataFrame]) -> DataFrame:
    """All rows of tables with like columns; missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
