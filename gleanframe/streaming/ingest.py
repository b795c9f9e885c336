"""Ingestion as a stream that ends when all files are read, and windows over events."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.batch import process
from ..sources import files

def ingest_available(spark: SparkSession, source: str, schema: str, sink: Callable[[DataFrame, int], None], checkpoint: str, files_at_once: int = 1000) -> None:
    """Hand every file of a folder that wasn't read yet to ``sink`` (rows, batch number), then stop.

    What was read is kept in the checkpoint; the sink is idempotent, so a batch may come twice.
    """
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(source)
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def ingest_files(spark: SparkSession, root: str, out: str, checkpoint: str, files_at_once: int = 1000, **how) -> list[dict[str, int]]:
    """Ingest the submissions below ``root`` that weren't yet, in batches of up to ``files_at_once``, then stop; rows added by layer of each batch.

    The checkpoint is the ledger of files seen; each batch is committed under its number there, so one
    that failed comes again, finds its recorded answers and adds its rows once. ``how`` goes to ``process``.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    base, added, stream = at.toUri().getPath(), [], hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def sink(rows: DataFrame, number: int) -> None:
        named = rows.withColumnsRenamed({"modificationTime": "modified"}).withColumn("path", F.regexp_replace("path", "^[a-z]+:/+", "/"))
        added.append(process(files.attributed(named, base), out, id=f"{stream}-{number}", **how))

    binary = "path string, modificationTime timestamp, length long, content binary"
    source = spark.readStream.format("binaryFile").schema(binary).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_at_once).load(root)
    source.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return added


def tumbling_counts(events: DataFrame, time: str = "ts", by: str = "event_type", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their mean value by window and kind; in a stream, events later than ``late`` are left out."""
    marked = events.withWatermark(time, late) if events.isStreaming else events
    out = marked.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("events"), F.avg("value").alias("mean_value"))
    return out.select(F.col("w.start").alias("window_start"), by, "events", "mean_value")
