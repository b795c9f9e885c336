"""A text index over chunks: postings in blocks, and exact BM25 top-k that leaves out blocks by upper bounds.

A block holds a term's postings among neighbouring rows, and the greatest weight in it. What the
best blocks give bounds a query's k-th score from below. Terms that can't reach it even together
are looked up only in blocks where other terms are, and other blocks only if their bound reaches it.
A task holds all postings of its blocks, so that only rows which reach the bound leave it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import scratch

#: Saturation of repeated words and normalisation by length.
K1, B = 1.2, 0.75
#: Numbers of rows in a block.
SPAN = 1024
#: Tasks that blocks are dealt over, at most.
MOST_TASKS = 4000
#: Scores that differ by less are ties, decided by id.
DIGITS = 6


@dataclass
class TextIndex:
    """``rows`` (number, id), ``blocks`` (term, block, top, numbers, weights) and ``terms`` (term, idf, best), stored."""

    rows: DataFrame
    blocks: DataFrame
    terms: DataFrame


def words(text: Column) -> Column:
    """Words of letters and digits in lower case; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _tasks(blocks: int) -> int:
    """Tasks for so many blocks: two in each, so that what a task counts or scores stays small."""
    return min(max(1, -(-blocks // 2)), MOST_TASKS)


def build(chunks: DataFrame, id: str, text: str, path: str) -> TextIndex:
    """Index the chunks below ``path``, which must be new. Ids may repeat; chunks without words are found by nothing.

    The words travel once, to the task of their block; it counts them and makes the block's postings.
    """
    spark = chunks.sparkSession
    cut = chunks.select(F.monotonically_increasing_id().alias("number"), F.col(id).alias("id"), words(F.col(text)).alias("words"))
    cut = cut.select("number", "id", F.size("words").alias("size"), F.array_join("words", " ").alias("words"))
    cut.write.option("compression", "zstd").parquet(f"{path}/cut")  # numbers are fixed from here on
    cut = spark.read.schema(cut.schema).parquet(f"{path}/cut").withColumn("block", F.floor(F.col("number") / SPAN))
    n, mean, blocks = cut.agg(F.count("*"), F.avg("size"), F.countDistinct("block")).first()
    placed = cut.where("size > 0").select("block", "number", "size", "words").repartition(_tasks(blocks), "block")
    counts = placed.select("block", "number", "size", F.explode(F.split("words", " ")).alias("term")).groupBy("block", "number", "size", "term").agg(F.count("*").alias("n"))
    weight = F.col("n") * (K1 + 1) / (F.col("n") + K1 * (1 - B + B * F.col("size") / F.lit(float(mean or 1) or 1.0)))
    weighed = counts.select("term", "block", F.struct("number", weight.alias("weight")).alias("x"))
    listed = weighed.groupBy("block", "term").agg(F.max("x.weight").alias("top"), F.array_sort(F.collect_list("x")).alias("x"))
    blocks = listed.select("term", "block", "top", F.col("x.number").alias("numbers"), F.col("x.weight").alias("weights"))
    blocks.sortWithinPartitions("term", "block").write.option("compression", "zstd").parquet(f"{path}/blocks")
    stored = spark.read.schema(blocks.schema).parquet(f"{path}/blocks")
    df = F.sum(F.size("numbers"))
    idf = F.log1p((F.lit(n) - df + 0.5) / (df + 0.5))
    stored.groupBy("term").agg(idf.alias("idf"), F.max("top").alias("best")).write.parquet(f"{path}/terms")
    return opened(spark, path, cut.schema["id"].dataType.simpleString())


def opened(spark: SparkSession, path: str, id_type: str = "string") -> TextIndex:
    """An index that was built before."""
    rows = spark.read.schema(f"number long, id {id_type}").parquet(f"{path}/cut")
    blocks = spark.read.schema("term string, block long, top double, numbers array<long>, weights array<double>").parquet(f"{path}/blocks")
    return TextIndex(rows, blocks, spark.read.schema("term string, idf double, best double").parquet(f"{path}/terms"))


def _scored(blocks: DataFrame, *more: str) -> DataFrame:
    """(q, number, score) of the postings of blocks with their queries' ``q`` and ``idf``; ``more`` columns stay."""
    each = blocks.select("q", "idf", *more, F.explode(F.arrays_zip("numbers", "weights")).alias("x"))
    return each.select("q", *more, F.col("x.numbers").alias("number"), (F.col("x.weights") * F.col("idf")).alias("score"))


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read again: the planner sees its size, and the index isn't shuffled for a few queries."""
    path = scratch.fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def plan_of(index: TextIndex, queries: DataFrame, q: str, text: str, k: int) -> tuple[DataFrame, DataFrame]:
    """(q, term, idf, bound, floor, essential) of each query's words, and what blocks there are to read for the essential ones.

    ``bound`` is what the query's other words can add to a score, ``floor`` what its k-th score is at least.
    """
    asked = _written(queries.select(F.col(q).alias("q"), F.explode(F.array_distinct(words(F.col(text)))).alias("term")).distinct(), "asked")
    asked = _written(asked.join(index.terms, "term").withColumn("most", F.col("idf") * F.col("best")), "asked")
    named = asked.select("term").distinct()
    heads = _written(index.blocks.join(named, "term", "left_semi").groupBy("term").agg(F.max_by("block", F.struct("top", -F.col("block"))).alias("block")), "heads")
    first = index.blocks.join(heads, ["term", "block"], "left_semi").join(asked.select("q", "term", "idf"), "term")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    sure = _scored(first).groupBy("q", "number").agg(F.sum("score").alias("score")).withColumn("_k", rank).where(F.col("_k") <= k)
    floors = sure.where(F.col("_k") == k).select("q", F.col("score").alias("floor"))
    known = asked.join(floors, "q", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)) - 10.0**-DIGITS)
    upto = F.sum("most").over(Window.partitionBy("q").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0))
    rest = F.sum("most").over(Window.partitionBy("q")) - F.col("most")
    known = _written(known.withColumns({"essential": upto >= F.col("floor"), "bound": rest}), "plan")
    return known, _reaching(index.blocks, known.where("essential"))


def _reaching(blocks: DataFrame, known: DataFrame) -> DataFrame:
    """The blocks of the queries' words in which a row with the word may reach the query's floor."""
    asked = blocks.join(known.select("q", "term", "idf", "bound", "floor", "essential"), "term")
    return asked.where(F.col("top") * F.col("idf") + F.col("bound") >= F.col("floor"))


def search(index: TextIndex, queries: DataFrame, q: str = "q", text: str = "text", k: int = 10) -> DataFrame:
    """(q, id, rank, score): the ``k`` best chunks of each query by BM25, of equal ones (to ``DIGITS`` digits) the smaller id first.

    The same as scoring every chunk; a chunk without any word of the query has no score. A word
    counts once in a query. Queries without known words, or null, find nothing. A posting travels
    once, to the task of its block, whatever the number of queries; a task sums the scores of its rows and
    lets only those go on that reach their query's floor.
    """
    known, essential = plan_of(index, queries, q, text, k)
    places = _written(essential.select("block").distinct(), "places")
    read = index.blocks.join(known.select("term").distinct(), "term", "left_semi").join(places, "block", "left_semi")
    each = _scored(_reaching(read.repartition(_tasks(places.count()), "block"), known), "block", "essential", "floor")
    found = each.groupBy("q", "block", "number").agg(F.sum("score").alias("score"), F.max("essential").alias("essential"), F.max("floor").alias("floor"))
    total = found.where("essential and score >= floor").select("q", "number", F.round("score", DIGITS).alias("score"))
    named = total.join(index.rows, "number")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id", "number"))
    return named.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("q").alias(q), "id", "rank", "score")
