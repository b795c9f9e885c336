"""Batches of appends to several layers, visible together or not at all.

A batch writes below ``<out>/<layer>/<team>/<report type>/batch=<attempt>``; one small file below
``<out>/batches`` commits it, and readers take the attempts named there alone. Beside a layer,
``<out>/seen`` has Bloom filters of its keys by folder, so that an append reads stored keys only
where one of its own may be among them. One batch at a time may write to a layer.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bits of a block of a filter (a Spark bitmap), keys meant for one, and bits set for each: 0.2 % of other keys seem to be in it.
BITS, KEYS_A_BLOCK, HASHES = 32768, 2500, 6
#: Folders of an append that become literal filters, at most; beyond them the folders are joined.
FOLDERS = 1000
#: Attempts named in a filter, at most; beyond them they are joined.
NAMED = 5000
#: Keys whose bits one task sets, about.
KEYS_A_TASK = 500_000
#: Filters are asked only if a layer has so many times a batch's rows; reading and dealing fewer keys costs less.
AS_MANY = 2
#: Share of a batch's keys that is looked at for such with many copies, and how often one is then seen.
LOOKED_AT, OFTEN = 0.001, 50
#: How files are packed: an append writes most of what it gets twice.
PACKED = "zstd"


def _system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    system, place = _system(spark, path)
    return system.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _system(spark, path)
    system.delete(place, True)


def commits(spark: SparkSession, out: str) -> list[dict]:
    """What each committed batch says of itself: id, attempt, and rows and schema by layer. A row a batch."""
    if not exists(spark, f"{out}/batches"):
        return []
    return [json.loads(r["value"]) for r in spark.read.option("pathGlobFilter", "*.json").text(f"{out}/batches", wholetext=True).collect()]


def _merged(schemas: Sequence[StructType]) -> StructType:
    """All columns of all schemas; those of one name agree."""
    out: dict = {}
    for s in schemas:
        for f in s:
            if out.setdefault(f.name, f).dataType != f.dataType:
                raise ValueError(f"{f.name} is {out[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
    return StructType(list(out.values()))


def _only(rows: DataFrame, attempts: list[str]) -> DataFrame:
    if len(attempts) <= NAMED:
        return rows.where(F.col("batch").isin(attempts))
    return rows.join(rows.sparkSession.createDataFrame([(a,) for a in attempts], "batch string"), "batch", "left_semi")


def _stored(spark: SparkSession, path: str, known: list[dict]) -> DataFrame | None:
    """Rows with ``batch``. The commits tell the columns, so no footer is read for them."""
    layer = path.rstrip("/").rpartition("/")[2]
    mine = [c for c in known if layer in c["layers"]]
    if not mine:
        return None
    schema = _merged([StructType.fromJson(c["layers"][layer]["schema"]) for c in mine])
    return _only(spark.read.schema(schema.add("batch", "string")).parquet(path), [c["attempt"] for c in mine])


def stored_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of a layer that committed batches wrote; None where there are none."""
    rows = _stored(spark, path, commits(spark, path.rstrip("/").rpartition("/")[0]))
    return None if rows is None else rows.drop("batch")


def in_folders(rows: DataFrame, folders: list[tuple] | DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The rows of the folders; as literals they reach the scan as partition filters."""
    if isinstance(folders, DataFrame):
        named = folders.toDF(*[f"_{c}" for c in by])
        return rows.join(named, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left_semi")
    if not by:
        return rows
    is_ = lambda c, v: F.col(c).isNull() if v is None else F.col(c) == v
    each = [all_of([is_(c, v) for c, v in zip(by, f, strict=True)]) for f in folders]
    out = F.lit(False) if not each else each[0]
    for x in each[1:]:
        out = out | x
    return rows.where(out)


def all_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for x in conditions[1:]:
        out = out & x
    return out


def _block(key: str, of: Column) -> Column:
    return F.pmod(F.xxhash64(key), of.cast("long"))


def _bits(key: str) -> Column:
    return F.array(*[F.pmod(F.xxhash64(F.col(key), F.lit(k)), F.lit(BITS)).cast("int") for k in range(HASHES)])


def filters(keys: DataFrame, key: str, by: tuple[str, ...], rows: int | None = None) -> DataFrame:
    """(by, of, block, bits): Bloom filters of the keys of each folder, in ``of`` blocks, a power of two.

    ``rows``, the number of keys, is counted if it isn't known. Keys are dealt by block before they become
    bits, of which each has several; the few folders are sent to all tasks, as a join would deal keys by folder.
    """
    tasks = math.ceil((keys.count() if rows is None else rows) / KEYS_A_TASK) or 1
    sizes = keys.groupBy(*by).agg(F.count("*").alias("_rows"))
    power = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_rows") / KEYS_A_BLOCK)))
    sized = sizes.withColumn("of", F.pow(F.lit(2.0), power).cast("long")).drop("_rows")
    named = sized.withColumnsRenamed({c: f"_{c}" for c in by}).withColumn("_all", F.lit(1))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by] or [F.col("_one") == F.col("_all")]
    joined = keys.withColumn("_one", F.lit(1)).join(F.broadcast(named), same)
    dealt = joined.select(*by, "of", _block(key, F.col("of")).alias("block"), key).repartition(tasks, *by, "of", "block")
    marks = dealt.select(*by, "of", "block", F.explode(_bits(key)).alias("bit"))
    return marks.groupBy(*by, "of", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))


def _set(bits: str, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col(bits), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), bit % 8)) % 2 == 1


def possible(keys: DataFrame, key: str, seen: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The keys that may be among those of the filters ``seen`` (of the same folders); no other key is."""
    sizes = [r["of"] for r in seen.select("of").distinct().collect()]  # powers of two
    if not sizes:
        return keys.select(key).limit(0)
    asked = keys.select(*by, key, F.explode(F.array(*[F.lit(x).cast("long") for x in sizes])).alias("of")).withColumn("block", _block(key, F.col("of")))
    held = seen.withColumnsRenamed({c: f"_{c}" for c in (*by, "of", "block")})
    on = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*by, "of", "block")]
    return asked.join(held, on).where(F.forall(_bits(key), lambda b: _set("bits", b))).select(key).distinct()


class Batch:
    """A batch below ``out``: appends become visible when the ``with`` block ends without an error.

    A batch whose ``id`` is committed already does nothing: its appends add no rows. What a failed
    attempt wrote stays invisible and is removed by ``vacuum``.
    """

    def __init__(self, spark: SparkSession, out: str, id: str | None = None):
        self.spark, self.out, self.id = spark, out, id or uuid.uuid4().hex
        self.attempt, self.layers = f"{self.id}-{uuid.uuid4().hex[:8]}", {}
        self.known = commits(spark, out)
        self.done = any(c["id"] == self.id for c in self.known)
        self.work = f"{out}/work/{self.attempt}"

    def __enter__(self) -> Batch:
        return self

    def __exit__(self, kind, error, trace) -> None:
        delete(self.spark, self.work)
        if kind is None and self.layers and not self.done:
            self.commit()

    def commit(self) -> None:
        system, place = _system(self.spark, f"{self.out}/batches/{self.id}.json")
        _, part = _system(self.spark, f"{self.out}/batches/{self.attempt}.part")
        f = system.create(part, True)
        f.write(bytearray(json.dumps({"id": self.id, "attempt": self.attempt, "layers": self.layers}).encode()))
        f.close()
        if not system.rename(part, place):
            system.delete(part, False)
            raise RuntimeError(f"batch {self.id} was committed meanwhile")

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written for this batch alone and read again: it is computed once, whatever reads it."""
        path = f"{self.work}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path, compression=PACKED)
        return self.spark.read.schema(df.schema).parquet(path)

    def append(self, rows: DataFrame, layer: str, key: str = "content_hash", order: tuple[str, ...] = ("doc", "pos"), by: tuple[str, ...] = ("team", "report_type")) -> int:
        """Append the rows that a layer lacks, in folders by ``by``; returns their number. Columns may be new.

        Rows without a key get the hash of their JSON. Of rows with one key the first by ``order`` is
        taken. Where much more is stored than comes, filters of the touched folders are read, and
        stored keys of those folders only if a key may be among them. Without rows nothing is written.
        """
        from .layers import keyed, new_rows, typed

        if self.done:
            return 0
        path = f"{self.out}/{layer}"
        known = self.written(keyed(typed(rows), key), layer)
        rows_given = known.count()
        found = known.select(*[F.col(c).cast("string").alias(c) for c in by]).distinct()
        few = found.limit(FOLDERS + 1).collect() if by else [()]
        if not few:
            return 0
        folders = found if len(few) > FOLDERS else [tuple(r) for r in few]
        held, stored = None, _stored(self.spark, path, self.known)
        if stored is not None:
            held, mine = in_folders(stored, folders, by).select(key), [c for c in self.known if layer in c["layers"]]
            if sum(c["layers"][layer]["rows"] for c in mine) > AS_MANY * rows_given:
                seen = self.spark.read.schema(", ".join([*(f"`{c}` string" for c in by), "of long, block long, bits binary, batch string"])).parquet(f"{self.out}/seen/{layer}")
                maybe = self.written(possible(known, key, in_folders(_only(seen, [c["attempt"] for c in mine]), folders, by), by), "possible")
                held = None if maybe.isEmpty() else held.join(maybe, key, "left_semi")
        copies = rows_given * LOOKED_AT > OFTEN and not known.sample(LOOKED_AT, 1).groupBy(key).count().where(F.col("count") >= OFTEN).isEmpty()
        # stored keys are taken out where the first row of each key is found: whole rows are dealt once
        fresh = new_rows(known, held, key, order, copies)
        added = Observation()
        marked = fresh.observe(added, F.count(F.lit(1)).alias("n")).withColumn("batch", F.lit(self.attempt))
        marked.write.mode("append").partitionBy(*by, "batch").parquet(path, compression=PACKED)
        n = added.get["n"]
        if n:
            kept = self.spark.read.schema(fresh.schema.add("batch", "string")).parquet(path).where(F.col("batch") == self.attempt)
            made = filters(kept.select(*by, key), key, by, n).withColumn("batch", F.lit(self.attempt))
            made.write.mode("append").partitionBy(*by, "batch").parquet(f"{self.out}/seen/{layer}")
            self.layers[layer] = {"rows": n, "schema": fresh.schema.jsonValue()}
        return n


def vacuum(spark: SparkSession, out: str, layer: str, by: tuple[str, ...] = ("team", "report_type")) -> int:
    """Delete what attempts that weren't committed left of a layer; no batch may be running. Returns the number of folders."""
    known = {c["attempt"] for c in commits(spark, out)}
    n = 0
    for place in (f"{out}/{layer}", f"{out}/seen/{layer}"):
        system, root = _system(spark, place)
        if system.exists(root):
            for x in system.globStatus(_system(spark, f"{place}/{'*/' * len(by)}batch=*")[1]):
                if x.getPath().getName().removeprefix("batch=") not in known:
                    system.delete(x.getPath(), True)
                    n += 1
    delete(spark, f"{out}/work")
    return n
