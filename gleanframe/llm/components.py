"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _to_least(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link each neighbour of a node ``u`` (only those larger than it, if asked) to the least of its surroundings."""
    # a written table, so that Spark can split the join at nodes with very many neighbours
    least = staged(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least")), "least")
    linked = pairs.join(least, "u")
    if larger_only:
        return linked.where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = least.where("least < u").select("u", F.col("least").alias("v"))
    return linked.where("v > least").select(F.col("v").alias("u"), F.col("least").alias("v")).unionByName(own)


def connected_components(edges: DataFrame, left: str = "a", right: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of an edge; the component is its least node.

    Nulls and loops are ignored. Each round is a staged table, so lost executors cost one round.
    """
    a, b = F.col(left).cast("long"), F.col(right).cast("long")
    pairs = staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(a.isNotNull() & b.isNotNull() & (a != b)).distinct(),
        "edges",
    )
    sign = lambda df: tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 1000003)).first())
    seen = sign(pairs)
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = staged(_to_least(both, True).distinct(), "large-star")
        pairs = staged(_to_least(large, False).where("u <> v").distinct(), "small-star")
        now = sign(pairs)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = pairs.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
