"""Distributed positional inverted index: exact phrases and proximity by intersected posting lists.

DataFrame functions only. A posting is (term, document row, position); only the terms of the
queries are stored. Posting lists are shifted by a term's place in its query and intersected, those
of the rarest terms first, so that the lists of frequent terms are read only where rare ones agree.
"""

from __future__ import annotations

import string
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import operator, staged

#: Words are runs of these characters: digits, small letters, and all beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Stands for the end of a document in the index; no word is empty.
END = ""


def words(text: str | Column) -> Column:
    """The words of a text with A-Z lower-cased; null has none."""
    small = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(small, F.lit(WORD), F.lit(0))


@dataclass
class Index:
    """``terms`` (word, term), ``postings`` (row, id, pos, term) and ``frequencies`` (term, frequency); END is posted at the end of each document."""

    terms: DataFrame
    postings: DataFrame
    frequencies: DataFrame


def index(docs: DataFrame, id: str, text: str, vocabulary: DataFrame) -> Index:
    """The positions in ``docs`` of the words in the column ``word`` of ``vocabulary``.

    The vocabulary is a written table: Spark broadcasts it if its measured size is below its
    threshold, else it shuffles the words. Rows are numbered; ids may repeat or be null.
    """
    numbered = vocabulary.where(F.col("word").isNotNull() & (F.col("word") != END)).select("word").distinct()
    terms = staged(numbered.select("word", F.monotonically_increasing_id().alias("term")).unionByName(_end(docs)), "terms")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), words(text).alias("words"))
    tokens = rows.select("row", "id", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "word"))
    postings = staged(tokens.join(terms, "word").select("row", "id", "pos", "term"), "postings")
    return Index(terms, postings, staged(postings.where("term >= 0").groupBy("term").agg(F.count("*").alias("frequency")), "frequencies"))


def _end(docs: DataFrame) -> DataFrame:
    return docs.sparkSession.range(1).select(F.lit(END).alias("word"), F.lit(-1).cast("long").alias("term"))


def queries(items: DataFrame, id: str, text: str) -> DataFrame:
    """(item, item_id, words) of queries with a word; ``item`` numbers the rows."""
    out = items.select(F.monotonically_increasing_id().alias("item"), F.col(id).alias("item_id"), words(text).alias("words"))
    return staged(out.where(F.size("words") > 0), "queries")


def _ranked(found: Index, items: DataFrame, width: int) -> DataFrame:
    """(item, item_id, need, terms, windows): the terms of each query in order, and of each window of ``need``
    words that can occur the places of its rarest and second rarest term."""
    each = items.select("item", "item_id", F.posexplode("words").alias("at", "word")).join(found.terms, "word")
    each = each.join(found.frequencies, "term", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    listed = each.groupBy("item", "item_id").agg(F.array_sort(F.collect_list(F.struct("at", "term", "frequency"))).alias("terms"))
    n = F.size("terms")
    listed = listed.withColumn("need", F.least(n, F.lit(width)))
    rarity = lambda x: F.struct(x["frequency"].alias("frequency"), x["at"].alias("at"))
    window = lambda start: F.array_sort(F.transform(F.slice("terms", start + 1, F.col("need")), rarity))
    starts = F.transform(F.sequence(F.lit(0), n - F.col("need")), window)
    possible = F.filter(starts, lambda w: w[0]["frequency"] > 0)
    pairs = F.transform(possible, lambda w: F.transform(F.slice(w, 1, 2), lambda x: x["at"]))
    return staged(listed.select("item", "item_id", "need", "terms", F.array_distinct(F.flatten(pairs)).alias("rare")).where(F.size("rare") > 0), "ranked")


def phrases(found: Index, items: DataFrame, width: int) -> DataFrame:
    """(row, item_id, first, last): where ``width`` or more consecutive words of a query (all, if it has fewer) stand in a document.

    A query laid along a document at some shift is an alignment. Lists of the rarest and second
    rarest term of each window give the alignments on which two of them agree (one, if a window
    is one word); the lists of the other terms are then read in these alignments' documents only.
    """
    ranked = _ranked(found, items, width)
    rare = ranked.select("item", "need", F.explode("rare").alias("at"), F.col("terms").alias("all"))
    rare = staged(rare.select("item", "need", "at", F.col("all")[F.col("at")]["term"].alias("term")), "rare")
    shifted = found.postings.join(rare, "term").select("row", "item", "need", (F.col("pos") - F.col("at")).alias("shift"), "at")
    agreed = shifted.groupBy("row", "item", "shift").agg(F.min("at").alias("low"), F.max("at").alias("high"), F.min("need").alias("need"))
    alignments = staged(agreed.where("low < high or need = 1").select("row", "item", "shift"), "alignments")
    near = found.postings.join(staged(alignments.select("row").distinct(), "near"), "row", "left_semi").select("row", "pos", "term")
    laid = alignments.join(ranked.select("item", "item_id", "need", F.col("terms").alias("of")), "item")
    laid = laid.select("row", "item", "item_id", "need", "shift", F.explode("of").alias("x"))
    laid = laid.select("row", "item", "item_id", "need", "shift", F.col("x.at").alias("at"), F.col("x.term").alias("term"), (F.col("shift") + F.col("x.at")).alias("pos"))
    agreeing = laid.join(near, ["row", "pos", "term"])
    own = ["row", "item", "shift"]
    island = F.col("at") - F.row_number().over(Window.partitionBy(*own).orderBy("at"))
    islands = agreeing.withColumn("island", island).groupBy(*own, "island", "item_id", "need").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    return islands.where(F.col("last") - F.col("first") + 1 >= F.col("need")).select("row", "item_id", "first", "last")


def proximity(docs: DataFrame, items: DataFrame, span: int, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(id, item_id, first, last): where all different words of a query stand within ``span`` words, in any order.

    ``first`` is a word of the query from which all others follow within the span, ``last`` where
    that is complete. Documents that lack a query's rarest term are left out before the other lists
    are read. Queries without words match nothing; null texts have none; empty tables give an empty one.
    """
    asked = queries(items, item_id, item_text)
    found = index(docs, id, text, asked.select(F.explode("words").alias("word")))
    each = asked.select("item", "item_id", F.size(F.array_distinct("words")).alias("need"), F.explode(F.array_distinct("words")).alias("word"))
    each = each.join(found.terms, "word").join(found.frequencies, "term", "left").withColumn("frequency", F.coalesce("frequency", F.lit(0)))
    lists = staged(each.select("item", "item_id", "need", "term", "frequency"), "lists")
    rarest = lists.groupBy("item").agg(F.min(F.struct("frequency", "term")).alias("x")).where("x.frequency > 0").select("item", F.col("x.term").alias("term"))
    hold = staged(found.postings.join(staged(rarest, "rarest"), "term").select("row", "item").distinct(), "hold")
    near = found.postings.join(staged(hold.select("row").distinct(), "near"), "row", "left_semi")
    met = near.join(lists, "term").join(hold, ["row", "item"], "left_semi")
    ahead = Window.partitionBy("row", "item").orderBy("pos").rangeBetween(0, span - 1)
    # the last word to come first, by the first place of each word from here on
    seen = F.collect_list(F.struct("term", "pos")).over(ahead)
    firsts = F.transform(F.array_distinct(F.transform("seen", lambda x: x["term"])), lambda t: F.array_min(F.transform(F.filter("seen", lambda x: x["term"] == t), lambda x: x["pos"])))
    kept = met.withColumn("seen", seen).withColumn("firsts", firsts).where(F.size("firsts") == F.col("need"))
    return staged(kept.select(F.col("id").alias(id), "item_id", F.col("pos").alias("first"), F.array_max("firsts").alias("last")), "proximity")


@operator
def contaminated(
    docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", *, width: int = 10
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    A window is ``width`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A document's word inside any occurrence of a window is hit. ``n_items`` counts the
    different ids of items with occurring windows, ``items_sha256`` is of these ids, sorted as text
    and joined by commas. Null has no words; repeated rows come back as often as they stand there;
    items that repeat an id count once, items without an id hit words only. Other columns are
    ignored, whatever their names. Empty tables of documents give an empty one, of items no hits.
    """
    asked = queries(items, item_id, item_text)
    found = index(docs, id, text, asked.select(F.explode("words").alias("word")))
    hits = staged(phrases(found, asked, width), "hits")
    covered = hits.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("row").agg(F.count("*").alias("n_hit"))
    listed = hits.select("row", F.col("item_id").cast("string").alias("item_id")).distinct().groupBy("row").agg(F.array_sort(F.collect_list("item_id")).alias("listed"))
    own = f"row_{uuid.uuid4().hex}"
    verdicts = staged(covered.join(listed, "row").withColumnRenamed("row", own), "verdicts")
    ends = found.postings.where("term = -1").select("row", "id", F.col("pos").cast("long").alias("n_words"))
    out = ends.join(verdicts, F.col("row") == F.col(own), "left")
    ids = F.coalesce("listed", F.array().cast("array<string>"))
    return out.select(
        F.col("id").alias(id), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )
