"""Near-duplicate groups by b-bit MinHash, confirmed on full shingle sets.

1. Each text gets the set of its word shingles (128-bit hashes), ``bands`` x ``rows`` minima, a key
   per band and a signature of the low ``BITS`` bits of all minima.
2. Texts with equal sets (by a BLAKE2 digest of the set) form a class, whose smallest id stands for it.
3. Classes that share a band key are candidates. Buckets of up to ``SMALL`` classes give all their
   pairs, larger ones the pairs with their smallest id. The similarity estimated from the
   signatures' bit counts, corrected for chance collisions, drops those far below the threshold;
   the others are confirmed on the full sets, word by word. For that each text travels once to
   its pivot, and the pivot's text once for ``LOT`` of them.
4. Large buckets whose members aren't yet in one component go through an exact prefix-filter
   join: two sets can only reach the threshold if they share one of their rarest shingles. It
   gives pairs across components only, so a group of many near copies costs no square.
5. Links make components; each document has the least id of its own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import by_batch, operator, rows_of, staged, strings
from .components import connected_components
from .shingles import constants, exact_sets, mix, shingle_sets

BITS = 2
PER_LONG = 64 // BITS
SMALL = 8
#: Texts compared with one copy of their pivot, on average.
LOT = 64
#: Standard deviations of the estimate that a candidate may lie below the threshold.
SLACK = 6.0

_SIGNED = "id long, n_shingles long, set_a long, set_b long, keys array<long>, bits array<long>"


def signatures(sets: list[np.ndarray], rows: int, bands: int) -> tuple[np.ndarray, np.ndarray]:
    """Band keys (texts x bands) and packed low bits of the minima (texts x longs) of non-empty sets."""
    total, factors, q = rows * bands, constants(rows * bands, 11), constants(rows, 3)
    keys, bits = [], []
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= 1 << 15):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *map(len, sets[at : end - 1])])
        least = np.empty((end - at, total), np.uint64)
        for k in range(total):
            least[:, k] = np.minimum.reduceat(flat * factors[k], starts)
        banded = (least.reshape(-1, bands, rows) * q).sum(axis=2, dtype=np.uint64)
        keys.append(mix(banded + constants(bands, 29)))
        low = (least >> np.uint64(20)) & np.uint64((1 << BITS) - 1)
        low = np.pad(low, ((0, 0), (0, -total % PER_LONG))).reshape(end - at, -1, PER_LONG)
        bits.append((low << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64))
        at = end
    return np.concatenate(keys).view(np.int64), np.concatenate(bits).view(np.int64)


def _lists(a: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(np.ascontiguousarray(a).ravel()), a.shape[1]).cast(pa.list_(pa.int64()))


def signed(docs: DataFrame, id: str, text: str, width: int, rows: int, bands: int) -> DataFrame:
    """Per document: size and fingerprint of its shingle set, band keys and signature (null without words)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            sets = shingle_sets([x.encode() for x in strings(b.column(1))], width)
            some = [k for k, s in enumerate(sets) if len(s)]
            none = np.ones(len(sets), bool)
            none[some] = False
            prints, keys, bits = np.zeros((len(sets), 2), np.int64), np.zeros((len(sets), bands), np.int64), np.zeros((len(sets), -(-rows * bands // PER_LONG)), np.int64)
            if some:
                keys[some], bits[some] = signatures([np.ascontiguousarray(sets[k][:, 0]) for k in some], rows, bands)
            for k in some:
                prints[k] = np.frombuffer(hashlib.blake2b(np.ascontiguousarray(sets[k]), digest_size=16).digest(), "<i8")
            arrays = [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64())]
            arrays += [pa.array(prints[:, j], mask=none) for j in range(2)]
            for x in (keys, bits):
                arrays.append(pa.array(_lists(x).to_pylist(), pa.list_(pa.int64())) if not len(x) else _lists(x))
            yield pa.record_batch(arrays, names=["id", "n_shingles", "set_a", "set_b", "keys", "bits"])

    return by_batch(docs.select(F.col(id).alias("id"), F.col(text).alias("text")), work, _SIGNED)


def estimate(a: Column, b: Column, hashes: int) -> Column:
    """Jaccard similarity from two packed signatures, corrected for minima that agree in their low bits by chance."""
    mask = sum(1 << (k * BITS) for k in range(PER_LONG))
    differs = F.zip_with(
        a, b, lambda x, y: F.bit_count((x.bitwiseXOR(y)).bitwiseOR(F.shiftrightunsigned(x.bitwiseXOR(y), 1)).bitwiseAND(F.lit(mask).cast("long"))).cast("int")
    )
    same = 1 - F.aggregate(differs, F.lit(0), lambda s, x: s + x) / F.lit(float(hashes))
    chance = 2.0**-BITS
    return (same - chance) / (1 - chance)


def lowest_estimate(threshold: float, hashes: int) -> float:
    """What the estimate of a pair at the threshold stays above, but for ``SLACK`` standard deviations."""
    chance = 2.0**-BITS
    same = chance + (1 - chance) * threshold
    return threshold - SLACK * math.sqrt(same * (1 - same) / hashes) / (1 - chance)


def _linked(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 x intersection >= percent x union, and share anything."""
    if not len(p) or not len(q) or 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    found = np.searchsorted(p, q)
    found[found == len(p)] = 0
    shared = int((p[found] == q).sum())
    return shared > 0 and 100 * shared >= percent * (len(p) + len(q) - shared)


def confirmed(pairs: DataFrame, docs: DataFrame, id: str, text: str, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 x intersection >= percent x union.

    Pairs are dealt by their first member and a lot of its partners, so that no member meets all
    its partners in one task. Rows that share an id are linked by any of their texts.
    """
    # written tables on both sides, so that Spark can split the rows of a pivot with very many partners
    pairs = staged(pairs.select("a", "b"), "likely")
    degree = staged(pairs.groupBy("a").agg(F.ceil(F.count("*") / LOT).alias("lots")), "degrees")
    dealt = staged(pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), "lots").alias("lot")), "pairs")
    pivots = dealt.select(F.col("a").alias("id"), "a", "lot", F.lit(0).alias("role")).distinct()
    wanted = staged(pivots.unionByName(dealt.select(F.col("b").alias("id"), "a", "lot", F.lit(1).alias("role"))), "wanted")
    texts = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    met = texts.join(wanted, "id").select("a", "lot", "role", "id", "text").repartition("a", "lot").sortWithinPartitions("a", "lot", "role", "id")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []  # the group and its pivot's texts, which may have come with an earlier batch
        for b in rows_of(batches):
            found = strings(b.column(4))
            sets = exact_sets([t.encode() for t in [*own, *found]], width)
            carried, mine, sets = own, sets[: len(own)], sets[len(own) :]
            left, right = [], []
            for a, lot, role, key, t, s in zip(*(b.column(k).to_pylist() for k in range(4)), found, sets, strict=True):
                if (a, lot) != at:
                    at, carried, mine = (a, lot), [], []
                if not role:
                    carried.append(t)
                    mine.append(s)
                elif any(_linked(p, s, percent) for p in mine):
                    left.append(a)
                    right.append(key)
            own = carried
            yield pa.record_batch([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return by_batch(met, work, "a long, b long").distinct()


def _shingled(docs: DataFrame, width: int) -> DataFrame:
    """A row for each shingle of the documents (id, component, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            sets = [s[:, 0] for s in shingle_sets([x.encode() for x in strings(b.column(2))], width)]
            n = np.array([len(s) for s in sets])
            flat = np.concatenate([*sets, np.empty(0, np.uint64)]).view(np.int64)
            ids, comps = (np.repeat(b.column(k).to_numpy(), n) for k in (0, 1))
            yield pa.record_batch([ids, comps, pa.array(np.repeat(n, n)), pa.array(flat)], names=["id", "component", "n", "shingle"])

    return by_batch(docs.select("id", "component", "text"), work, "id long, component long, n long, shingle long")


def prefix_pairs(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of documents (id, component, text) of different components that share one of their rarest shingles.

    Complete: the shingles of all stand in one order, rarest first, and sets with 100 x
    intersection >= percent x union share one of the first n - ceil(n x percent / 100) + 1 of each.
    Where they share their first, what follows it in either bounds their intersection: the shorter
    set meets the longer at places only from which it could share enough with a set of its own
    length, and meets sets of lengths near its own alone. Sets that can't reach the share so don't meet.
    Members of the component that is most frequent at a shingle aren't paired with each other.
    """
    rows = staged(_shingled(docs, width), "rest-shingles")
    rarity = rows.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    # a shingle of one document alone matches nothing, but takes its place in the order
    alone = rows.join(rarity.select("shingle"), "shingle", "left_anti").groupBy("id").agg(F.count("*").alias("alone"))
    known = rows.join(rarity, "shingle").join(alone, "id", "left")
    order = Window.partitionBy("id").orderBy("df", "shingle")
    ranked = known.withColumn("at", F.row_number().over(order) + F.coalesce("alone", F.lit(0)))
    allowed = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    heads = staged(ranked.where(F.col("at") <= allowed).select("shingle", "id", "component", "n", "at"), "rest-heads")
    groups = heads.groupBy("shingle", "component").agg(F.count("*").alias("k"))
    main = groups.groupBy("shingle").agg(F.count("*").alias("kinds"), F.max(F.struct("k", "component")).alias("top")).where("kinds > 1")
    # both sides of each join are written tables, so that Spark can split the rows of a frequent shingle
    main = staged(main.select("shingle", F.col("top.component").alias("main")), "rest-main")
    band = F.floor(F.log(F.col("n").cast("double")) / math.log(100 / percent * 1.01 if percent < 100 else 1.01))
    marked = staged(heads.join(main, "shingle").withColumn("band", band), "rest-marked")
    # of a pair the shorter (of equal ones that of the smaller id) stands where the rest of it can still share enough
    # with a set of its own length at least; the longer one has at most 100 / percent as many: its band or the next
    enough = (100 + percent) * (1 + F.col("n") - F.col("at")) >= percent * 2 * F.col("n")
    short = marked.where(enough).select("shingle", "band", F.col("id").alias("x"), F.col("component").alias("cx"), F.col("n").alias("nx"), F.col("at").alias("ax"), (F.col("component") == F.col("main")).alias("mx"))
    long = marked.select("shingle", F.explode(F.array("band", F.col("band") - 1)).alias("band"), F.col("id").alias("y"), F.col("component").alias("cy"), F.col("n").alias("ny"), F.col("at").alias("ay"), (F.col("component") == F.col("main")).alias("my"))
    most = 1 + F.least(F.col("nx") - F.col("ax"), F.col("ny") - F.col("ay"))
    near = (F.col("cx") != F.col("cy")) & ((F.col("nx") < F.col("ny")) | ((F.col("nx") == F.col("ny")) & (F.col("x") < F.col("y"))))
    near = near & (100 * F.col("nx") >= percent * F.col("ny")) & ((100 + percent) * most >= percent * (F.col("nx") + F.col("ny")))
    met = lambda s, l: s.join(l, ["shingle", "band"]).where(near).select("x", "y")
    both = met(short.where("not mx"), long).unionByName(met(short.where("mx"), long.where("not my")))
    return both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


@operator
def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", *, width: int = 5, percent: int = 85, rows: int = 8, bands: int = 44
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row; ids are integers, not null.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A document's set holds its distinct
    shingles of ``width`` words, with fewer words the whole sequence; one without words (or null)
    is alone. Documents are linked if 100 x intersection >= ``percent`` x union of their full sets;
    ``component_id`` is the least id reachable, ``kept`` marks it. ``rows`` and ``bands`` set the
    candidate search: a pair at similarity s is missed with probability (1 - s**rows)**bands, 1e-6
    at 0.85. Rows that share an id are one node, linked by any of their texts, each with its own
    ``n_shingles``. Other columns are ignored, whatever their names. An empty table gives an empty one.
    """
    hashes = rows * bands
    known = staged(signed(docs, id, text, width, rows, bands), "signatures")
    classes = staged(known.where("set_a is not null").groupBy("set_a", "set_b", "n_shingles").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    reps = known.join(classes.select(F.col("rep").alias("id")), "id", "left_semi")
    banded = reps.select("id", F.explode("keys").alias("key"))
    buckets = staged(banded.groupBy("key").agg(F.count("*").alias("size"), F.min("id").alias("pivot")).where("size > 1"), "buckets")
    members = staged(banded.join(buckets, "key"), "members")

    few = members.where(F.col("size") <= SMALL)
    small = few.select("key", F.col("id").alias("a")).join(few.select("key", F.col("id").alias("b")), "key").where("a < b").select("a", "b")
    star = members.where((F.col("size") > SMALL) & (F.col("id") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("id").alias("b"))
    signs = known.select("id", "n_shingles", "bits")

    def likely(pairs: DataFrame) -> DataFrame:
        l, r = (signs.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
        sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
        return pairs.join(l, "a").join(r, "b").where(sizes & (estimate(F.col("bits_a"), F.col("bits_b"), hashes) >= lowest_estimate(percent / 100, hashes))).select("a", "b")

    links = staged(confirmed(likely(small.unionByName(star).distinct()), docs, id, text, width, percent), "links")
    found = connected_components(links)

    large = members.where(F.col("size") > SMALL).join(found, members["id"] == found["node"], "left")
    large = large.select("key", "id", F.coalesce("component", "id").alias("component"))
    split = large.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most").select("key")
    rest = staged(large.join(split, "key").select("id", "component").distinct(), "rest")
    if not rest.isEmpty():
        own = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
        more = prefix_pairs(rest.join(own, "id"), width, percent)
        links = links.unionByName(staged(confirmed(likely(more), docs, id, text, width, percent), "more-links"))
        found = connected_components(links)

    labels = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("set_a", "set_b", F.coalesce("component", "rep").alias("component_id"))
    out = known.select("id", "n_shingles", "set_a", "set_b").join(labels, ["set_a", "set_b"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(F.col("id").alias(id), "n_shingles", component.alias("component_id"), (component == F.col("id")).alias("kept"))
