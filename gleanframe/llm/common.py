"""What the training-data operators share: shared-folder stages, shipping, small expressions."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

#: What reaches Python at once, at most: texts can be long.
ARROW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}
#: A worker hands free memory back to the system whenever it has read so much.
_GIVE_BACK = 32 << 20
#: For stages of rows of megabytes: Parquet's writer looks at its size only every hundred rows, and its reader decodes as
#: many rows of a row group as it can, which else grows with what a task holds.
LARGE_ROWS = {
    "parquet.block.size": str(8 << 20), "parquet.block.row.count.limit": "4", "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "4",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "4",
}
_caches: list = []
_user = None
_local = threading.local()
_local_dirs: dict[str, str] = {}


def cached(function: Callable) -> Callable:
    """A function whose last results a worker keeps while it works for one operator."""
    out = functools.lru_cache(maxsize=2)(function)
    _caches.append(out)
    return out


def give_back() -> None:
    """Hand memory that is no longer used back to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def working_for(user: str) -> None:
    """Workers are used again; one that turns to another operator drops what it kept for the last."""
    global _user
    if user != _user:
        for c in _caches:
            c.cache_clear()
        _user = user
        gc.collect()
        give_back()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``.

    Where the setting is absent, a local session gets a temporary folder and any other the
    warehouse; a machine-local folder is never used on a cluster. The setting stays as it is.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local") and "cluster" not in context.master:
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = "file://" + tempfile.mkdtemp(prefix="gleanframe-")
        return _local_dirs[context.applicationId]
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, which goes when the session's JVM ends."""
    path = f"{shared_dir(spark)}/gleanframe/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def callers_path(spark: SparkSession, name: str) -> str:
    """A new folder for files that an operator returns: it goes with the operator that called this one, if any."""
    path = fresh_path(spark, name)
    scopes = getattr(_local, "scopes", None) or []
    if len(scopes) > 1:
        scopes[-2].append(path)
    return path


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings changed for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def staged(df: DataFrame, name: str, codec: str = "zstd", large_rows: bool = False) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again.

    Cuts the lineage: what comes after survives lost executors without computing this again,
    and the optimizer sees the written size when it picks a join. ``large_rows`` tells of rows of megabytes.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    scopes = getattr(_local, "scopes", None)
    if scopes:
        scopes[-1].append(path)
    with settings(spark, ARROW):
        df.write.option("compression", codec).options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def finished(stage: DataFrame) -> None:
    """Delete a stage that nothing reads any more, before its operator ends."""
    path = stage._staged_at
    for scope in getattr(_local, "scopes", []):
        if path in scope:
            scope.remove(path)
    _delete(stage.sparkSession, path)


def operator(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function whose result is staged, and whose own stages are deleted when that is done or has failed."""

    @functools.wraps(function)
    def run(*args, **kwargs) -> DataFrame:
        scopes = _local.__dict__.setdefault("scopes", [])
        own: list[str] = []
        scopes.append(own)
        try:
            try:
                out = function(*args, **kwargs)
            finally:
                scopes.pop()
            at = getattr(out, "_staged_at", None)
            if at in own:  # a stage already
                own.remove(at)
                done = out
                if scopes:
                    scopes[-1].append(at)
            else:
                done = staged(out, function.__name__)
        finally:
            for x in own:
                _delete(SparkSession.getActiveSession(), x)
        return done

    return run


def by_batch(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """``mapInArrow`` with the package shipped. ``staged`` writes it in batches of the sizes in ``ARROW``."""
    user = function.__module__
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working_for(user)
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def crc_fold(column: str | Column, folds: int) -> Column:
    """crc32 of the value as text, modulo ``folds``."""
    c = F.col(column) if isinstance(column, str) else column
    return F.crc32(c.cast("string").cast("binary")) % F.lit(folds)


def strings(values: pa.Array) -> list[str]:
    """Python strings; null is the empty text."""
    return [x or "" for x in values.to_pylist()]


def rows_of(batches: Iterable[pa.RecordBatch], most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most_bytes`` at most, so that long texts don't fill a worker."""
    read = 0
    for b in batches:
        n, size = b.num_rows, max(b.nbytes, 1)
        read += size
        step = max(1, n * most_bytes // size) if size > most_bytes else n
        for at in range(0, n, max(step, 1)):
            yield b.slice(at, step)
        if read > _GIVE_BACK:
            read = 0
            give_back()


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, by the session's default file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def file_system(uri: str):
    """The Arrow file system of a folder in shared storage and the path there."""
    from pyarrow import fs

    if uri.startswith("file:/"):
        return fs.LocalFileSystem(), "/" + uri[6:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_whole(system, path: str, write: Callable) -> None:
    """A file that appears complete or not at all: another attempt of the task may write the same."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    with system.open_output_stream(part) as f:
        write(f)
    system.move(part, path)
