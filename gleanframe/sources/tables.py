"""Stored tables and labelled truth."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.batches import stored_rows


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """A labelled CSV: header names without byte-order mark, case and blanks; page as an integer or null."""
    raw = spark.read.option("header", True).csv(path)
    named = raw.toDF(*[c.lstrip("﻿").strip().lower() for c in raw.columns])
    return named.withColumn("page", F.col("page").try_cast("double").cast("int")) if "page" in named.columns else named


def stored(spark: SparkSession, path: str, documents: list[str] | None = None, entities: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """A stored layer's committed rows, of some documents or entities; the filters reach the scan. An error if there are none."""
    df = stored_rows(spark, path)
    if df is None:
        raise FileNotFoundError(f"no batch is committed at {path}")
    if documents:
        df = df.where(F.col("source_document").isin(documents))
    if entities:
        df = df.where(F.col("entity_ref").isin(entities))
    return df.select(*columns) if columns else df


def table_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the catalog's tables that match a pattern with ``*``, without regard to case."""
    return sorted(t.name for t in spark.catalog.listTables(pattern=pattern))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)
