"""A folder that the driver and all executors see, for what a job writes for itself."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: dict[str, str] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which goes when the session's JVM ends.

    Where the setting is absent, a local session uses a temporary folder, any other the warehouse.
    """
    base, context = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext
    if not base and context.master.startswith("local") and "cluster" not in context.master:
        base = _local.setdefault(context.applicationId, "file://" + tempfile.mkdtemp(prefix="gleanframe-"))
    base = base or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"
    path = f"{base.rstrip('/')}/gleanframe/{name}-{uuid.uuid4().hex}"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path
