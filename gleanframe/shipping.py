"""Hands this package to the executors, where it need not be installed."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

PACKAGE = __name__.split(".")[0]


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors once per session, so that workers can import it."""
    if getattr(spark.sparkContext, "_gleanframe_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{PACKAGE}.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for x in sorted(names):
                if x.endswith(".py"):
                    full = os.path.join(folder, x)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(out)
    spark.sparkContext._gleanframe_shipped = True
