"""The package's source on every Python worker.

Functions that run in tasks import ``martflow`` there. The driver packs the
package's source files once per application and hands the archive to Spark
(``addPyFile``), which serves it to every executor, so nothing has to be
installed on the machines.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import martflow

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = os.path.dirname(os.path.abspath(martflow.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="martflow-src-"), "martflow_src.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def _release() -> None:
    """Give freed memory back to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(function: Callable) -> Callable:
    """function over batches, whose worker keeps no freed memory behind it: Spark
    keeps a worker for later tasks, beside those of the executor's JVM."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            _release()
    return run


def map_arrow(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with the package available to the function."""
    ship(df.sparkSession)
    return df.mapInArrow(releasing(function), schema)
