"""A ledger of answers: what a parser or a model was asked and said, so that nothing is asked twice.

A question is known by a key of its content, prompt and options. Questions that the ledger lacks are
dealt out by key; a task records its answers in files as it goes, and one that is run again, or a later
run after a failure, asks only what isn't recorded.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shipping import ship

ANSWERS = "key string, raw string, error string, answered timestamp"
#: Answers in a file at most: what a killed task loses. Tasks of a run at least.
SEGMENT, TASKS = 64, 16


def question(*parts: Column, options: dict | None = None) -> Column:
    """The key of a question: 256 bits of its parts in order, null apart from empty, and of the options by name."""
    shown = F.to_json(F.struct(*[x.alias(f"p{k}") for k, x in enumerate(parts)], F.lit(json.dumps(options or {}, sort_keys=True, default=str)).alias("options")))
    return F.sha2(shown, 256)


def _place(uri: str):
    """The Arrow file system of a folder and the path in it."""
    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[6:].lstrip("/")
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, by the session's default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def recorded(spark: SparkSession, path: str, retry_failed: bool = False) -> DataFrame:
    """(key, raw, error) of all answers, one a key: one that succeeded before one that failed, then the earliest.

    ``retry_failed`` leaves failures out, so that they are asked again.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "key string, raw string, error string")
    rows = spark.read.schema(ANSWERS).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(path)
    if retry_failed:
        rows = rows.where("error is null")
    n = F.row_number().over(Window.partitionBy("key").orderBy(F.col("error").isNotNull(), "answered", "raw"))
    return rows.withColumn("_n", n).where("_n = 1").select("key", "raw", "error")


def _log(answers: list[tuple], folder: str) -> None:
    """A file of answers that appears whole or not at all."""
    system, path = _place(folder)
    system.create_dir(path, recursive=True)
    keys, raws, errors = (list(x) for x in zip(*answers, strict=True))
    now = pa.array([pd.Timestamp.now("UTC").to_pydatetime()] * len(keys), pa.timestamp("us", "UTC"))
    table = pa.table({"key": pa.array(keys, pa.string()), "raw": pa.array(raws, pa.string()), "error": pa.array(errors, pa.string()), "answered": now})
    name = f"{path}/{uuid.uuid4().hex}"
    with system.open_output_stream(f"{name}.part") as f:
        pq.write_table(table, f)
    system.move(f"{name}.part", f"{name}.parquet")


def _logged(folder: str) -> set[str]:
    """Keys that an earlier attempt of a task recorded."""
    system, path = _place(folder)
    if system.get_file_info(path).type == fs.FileType.NotFound:
        return set()
    files = [x.path for x in system.get_file_info(fs.FileSelector(path)) if x.path.endswith(".parquet")]
    return {k for x in files for k in pq.read_table(x, columns=["key"], filesystem=system)["key"].to_pylist()}


def ask(questions: DataFrame, path: str, answer: Callable[[list[dict]], list[tuple[str | None, str | None]]], retry_failed: bool = False, segment: int = SEGMENT) -> int:
    """Answer the ``questions`` (key and whatever ``answer`` needs) that the ledger at ``path`` lacks; returns how many were asked.

    ``answer`` gets rows as dicts and gives (raw, error) for each. Equal keys are asked once. Rows are
    dealt out by key, so a task that runs again meets the same ones and leaves out what its
    forerunner recorded. Arrow must be able to write to the path's file system.
    """
    spark = questions.sparkSession
    lack = questions.join(recorded(spark, path, retry_failed).select("key"), "key", "left_anti")
    lack = lack.dropDuplicates(["key"]).repartition(max(TASKS, spark.sparkContext.defaultParallelism), "key")
    log = f"{qualified(spark, path)}/{uuid.uuid4().hex}"

    def work(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        folder = f"{log}/{TaskContext.get().partitionId()}"
        done, asked = _logged(folder), 0
        for f in frames:
            rows = [x for x in f.to_dict("records") if x["key"] not in done]
            for k in range(0, len(rows), segment):
                some = rows[k : k + segment]
                _log([(x["key"], *said) for x, said in zip(some, answer(some), strict=True)], folder)
                asked += len(some)
        yield pd.DataFrame({"asked": [asked]})

    ship(spark)
    return lack.mapInPandas(work, "asked long").agg(F.coalesce(F.sum("asked"), F.lit(0))).first()[0]


def answered(questions: DataFrame, path: str, answer: Callable[[list[dict]], list[tuple[str | None, str | None]]], retry_failed: bool = False, segment: int = SEGMENT) -> DataFrame:
    """``questions`` with the ledger's ``raw`` and ``error``, after asking what it lacks."""
    ask(questions, path, answer, retry_failed, segment)
    return questions.join(recorded(questions.sparkSession, path), "key", "left")


def compacted(spark: SparkSession, path: str, into: str, files: int = 1) -> DataFrame:
    """The ledger's answers written to a new folder in few files, and read from there."""
    recorded(spark, path).withColumn("answered", F.current_timestamp()).repartition(files, "key").write.parquet(into)
    return recorded(spark, into)
