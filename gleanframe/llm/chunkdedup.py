"""Exact duplicates by recipes of content-defined chunks. DataFrame functions only.

A text is cut where its content says so; each chunk gets a verified identifier, and texts are
compared by their ordered lists of identifiers. The text itself is never moved: what is shuffled
are 50 bytes a chunk and the lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import operator, staged


def _marks() -> str:
    """A regular expression for about a quarter of the characters of any script.

    Every fourth of ASCII; of the others runs of 8 in 32, and of 128 in 512 where scripts are large.
    """
    few = "".join(rf"\x{c:02x}" for c in range(1, 128, 4))
    runs = [(a, a + 7) for a in range(0x80, 0x3000, 32)] + [(a, a + 127) for a in range(0x3000, 0x10000, 512) if not 0xD700 < a < 0xE000]
    runs += [(a, a + 1023) for a in range(0x10000, 0x40000, 4096)]
    rest = "".join(rf"\x{{{a:x}}}-\x{{{z:x}}}" for a, z in runs)
    return rf"(?:[{few}]|(?![\x00-\x7f])[{rest}])"


#: A chunk ends behind two marks, when it has 512 characters, or at 4,096 characters.
CHUNK = rf"(?s).{{510,4094}}?(?:{_marks()}{{2}}|\z)|.{{1,4096}}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order; joined they are the text again. None for the empty text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(row, id, text_sha256, recipe) of each row: the verified identifiers of its chunks in order.

    An identifier is the 64-bit fingerprint of the chunk and an ordinal among the SHA-256 digests
    that share the fingerprint: chunks have the same identifier exactly if their digests agree.
    """
    plain = F.coalesce(text, F.lit(""))
    cut = F.transform(chunks(plain), lambda c: F.struct(F.xxhash64(c).alias("print"), F.unhex(F.sha2(c, 256)).alias("digest")))
    seen = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).alias("id"), F.sha2(plain, 256).alias("text_sha256"), cut.alias("cut"))
    seen = staged(seen, "chunks")  # row numbers are fixed from here on
    distinct = seen.select(F.explode("cut").alias("c")).select("c.*").distinct()
    clashing = distinct.groupBy("print").agg(F.count("*").alias("digests")).where("digests > 1").select("print")
    ordinal = F.row_number().over(Window.partitionBy("print").orderBy("digest"))
    others = staged(distinct.join(clashing, "print").select("print", "digest", ordinal.alias("ordinal")).where("ordinal > 1"), "clashes")
    first = lambda c: F.struct(c["print"].alias("print"), F.lit(1).alias("ordinal"))
    if others.isEmpty():  # no two digests share a fingerprint
        return seen.select("row", "id", "text_sha256", F.transform("cut", first).alias("recipe"))
    each = seen.select("row", F.posexplode("cut").alias("at", "c")).select("row", "at", "c.*").join(others, ["print", "digest"], "left")
    step = F.struct("at", "print", F.coalesce("ordinal", F.lit(1)).alias("ordinal"))
    listed = each.groupBy("row").agg(F.array_sort(F.collect_list(step)).alias("x")).select("row", F.transform("x", lambda x: F.struct(x["print"].alias("print"), x["ordinal"].alias("ordinal"))).alias("recipe"))
    empty = F.array().cast("array<struct<print:bigint,ordinal:int>>")
    return seen.select("row", "id", "text_sha256").join(listed, "row", "left").withColumn("recipe", F.coalesce("recipe", empty))


@operator
def exact_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) of every row; ids are not null.

    Texts are equal when identical, null counting as empty. Of the rows with equal texts that with
    the largest id is kept; of rows that repeat this id as well, one. Other columns are ignored,
    whatever their names. An empty table gives an empty one.
    """
    found = staged(recipes(docs, id, text), "recipes")
    groups = staged(found.groupBy("recipe").agg(F.max(F.struct("id", "row")).alias("last"), F.count("*").alias("group_size")), "groups")
    ours = found.join(groups, "recipe")
    return ours.select(F.col("id").alias(id), F.col("last.id").alias("keep_id"), "group_size", (F.col("row") == F.col("last.row")).alias("kept"), "text_sha256")
