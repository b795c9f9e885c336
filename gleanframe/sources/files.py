"""Submissions: files whose path says whom they belong to, and what their names tell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Levels of folders above a file, and the convention of file names.
LEVELS = ("team", "report_type", "entity", "entity_id", "entity_name")
FILE_NAME = r"^([A-Za-z0-9]+)_[A-Za-z0-9\-]+_[A-Za-z0-9\-]+_\d{4}-\d{2}-\d{2}\.[A-Za-z0-9]+$"


def one_spaced(c: Column) -> Column:
    return F.regexp_replace(F.trim(c), r"\s+", " ")


def entity_of_file_name(name: Column) -> Column:
    """The entity in a file name of the convention, else null."""
    return F.nullif(F.regexp_extract(F.trim(name), FILE_NAME, 1), F.lit(""))


def attributed(paths: DataFrame, root: str, path: str = "path") -> DataFrame:
    """The files exactly five folders below the root, none of them hidden, with a column for each folder."""
    below = F.split(F.substring(F.col(path), len(root.rstrip("/")) + 2, 1 << 30), "/")
    named = paths.where(F.col(path).startswith(root.rstrip("/") + "/")).withColumn("_parts", below)
    named = named.where((F.size("_parts") == len(LEVELS) + 1) & ~F.exists("_parts", lambda x: x.startswith(".") | (x == "")))
    named = named.withColumns({k: F.col("_parts")[i] for i, k in enumerate(LEVELS)})
    return named.withColumn("entity_ref", one_spaced(F.col("entity"))).drop("_parts")


def first_paths(paths: DataFrame, limit: int | None, path: str = "path") -> DataFrame:
    """The first ``limit`` rows by path (0 or None: all, in no order); each task keeps so many."""
    return paths.orderBy(path).limit(limit) if limit else paths


def submissions(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """All submissions below a root, or the first ``limit`` by path (0 or None: all); empty if there is no such root.

    Files are listed and, with a limit, sorted by their names; the content is read of those alone
    that are chosen, and only by those who select it.
    """
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], "path string, content binary, modified timestamp, team string, report_type string, entity string, entity_id string, entity_name string, entity_ref string")
    base = at.toUri().getPath()
    named = lambda df: attributed(df.withColumn("path", F.regexp_replace("file", "^[a-z]+:/+", "/")), base)
    read = lambda *where: spark.read.format("binaryFile").option("recursiveFileLookup", True).load([*where]).withColumnsRenamed({"path": "file", "modificationTime": "modified"})
    where = [root]
    if limit:
        where = [r["file"] for r in first_paths(named(read(root).select("file")), limit).select("file").collect()]  # ``limit`` names
        if not where:
            where, limit = [root], None
    return named(read(*where)).select("path", "content", "modified", *LEVELS, "entity_ref")


def images_by_time(files: DataFrame, pattern: str = r"(?i)\.(png|jpe?g)$") -> DataFrame:
    """(place, path, modified) of image files, numbered by time of change, then by path, within their folder."""
    folder = F.substring_index("path", "/", -1)
    found = files.where(F.col("path").rlike(pattern)).select("path", "modified").withColumn("folder", F.expr("substring(path, 1, length(path) - length(substring_index(path, '/', -1)))"))
    return found.withColumn("place", F.row_number().over(Window.partitionBy("folder").orderBy("modified", "path")) - 1).select("folder", "place", "path", "modified", folder.alias("name"))
