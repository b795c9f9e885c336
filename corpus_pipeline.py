"""A corpus pipeline: quality rules, language, boilerplate lines, near copies, packing.

Each stage works on all that its predecessor kept. Ids of dropped documents come back as a written
table, which Spark broadcasts if its measured size is below its threshold.

Every stage passes the columns of its input on, also those that it doesn't know. Null and empty
texts have too few words and go in the first stage. Of rows that share an id, all stay or all go:
they go if each of them is dropped. Ties are settled by the operators. An empty table stays empty.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm.common import operator, staged
from gleanframe.llm.fertility import judged
from gleanframe.llm.hyperlang import UNKNOWN, identified, learn
from gleanframe.llm.linefreq import without_boilerplate
from gleanframe.llm.minhash import near_duplicates
from gleanframe.llm.packing import packed

#: A text may lie so many interquartile ranges below its language's lower quartile of the fit, or so
#: far if that is more, and for the noise of short texts this over the root of its n-grams.
FENCES, REACH, NOISE = 3.0, 0.5, 1.0


def _without(docs: DataFrame, verdicts: DataFrame, dropped: Column, name: str) -> DataFrame:
    """The documents without those whose verdict is ``dropped``; rows that share an id go only if all of them are dropped."""
    gone = verdicts.groupBy("doc_id").agg(F.bool_and(F.coalesce(dropped, F.lit(False))).alias("gone")).where("gone").select("doc_id")
    return docs.join(staged(gone, name), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the tokeniser bands of their language."""
    return _without(docs, judged(docs), ~F.col("kept"), "poor")


def _lowest(quartiles: Column) -> Column:
    return quartiles[0] - F.greatest(FENCES * (quartiles[1] - quartiles[0]), F.lit(REACH))


def foreign(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``found`` with ``foreign``: whether the text has no letters or doesn't fit the language found for it.

    The band of a language is drawn around the quartiles of all its documents for which it was found;
    a language without any has that of all documents.
    """
    quartiles = F.percentile(F.floor(F.col("fit") * 256) / 256, F.array(F.lit(0.25), F.lit(0.75)))
    some = found.where(F.col("lang_pred") != UNKNOWN)
    own = some.join(docs.select("doc_id", F.col("lang").alias("lang_pred")), ["doc_id", "lang_pred"], "left_semi")
    edges = staged(own.groupBy("lang_pred").agg(_lowest(quartiles).alias("low")), "language-bands")
    overall = some.agg(_lowest(quartiles)).first()[0]
    low = F.coalesce("low", F.lit(overall)) - NOISE / F.sqrt(F.greatest("n_ngrams", F.lit(1)))
    return found.join(edges, "lang_pred", "left").withColumn("foreign", (F.col("lang_pred") == UNKNOWN) | (F.col("fit") < low))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the corpus itself teaches (all, if it teaches none); missing languages are filled in."""
    profiles = learn(docs)
    if not profiles.languages:
        return docs
    found = identified(docs, profiles, fit=True)
    kept = _without(docs, foreign(found, docs), F.col("foreign"), "no-language")
    missing = found.join(docs.where("lang is null").select("doc_id"), "doc_id", "left_semi")
    own = f"found_{uuid.uuid4().hex}"
    missing = staged(missing.groupBy("doc_id").agg(F.min("lang_pred").alias(own)), "filled")
    filled = kept.join(missing, "doc_id", "left").withColumn("lang", F.coalesce("lang", own))
    return filled.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source.

    Boilerplate is on five documents at least; a document of nothing else is left to the next stage, as a copy.
    """
    out = without_boilerplate(docs, min_pages=5, keep_copies=True).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 0.8 or more of 5-word shingles; a pair at 0.8 is missed with probability 1e-6."""
    return _without(docs, near_duplicates(docs, percent=80, rows=6, bands=46), ~F.col("kept"), "copies")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 ids."""
    return packed(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("packing", packing)]
#: SQL has no tokenisers; the tests compare with brute force.
ORACLE_SQL = None


@operator
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over all documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
