"""Prepares a session for these operators: the package on its Python workers, batches of moderate size."""

from __future__ import annotations

import os
import tempfile
import zipfile

import furlong
from pyspark.sql import SparkSession

#: Rows of texts in an Arrow batch, at most; both the JVM and the worker hold batches outside of their heaps.
BATCH_ROWS = 2_000
_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_sent: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Add the package as a Python file of the application, once, and bound the rows of its Arrow batches."""
    rows = int(spark.conf.get(_ROWS))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_ROWS, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    root = os.path.dirname(os.path.abspath(furlong.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="furlong-py-"), "furlong.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(root)))
    spark.sparkContext.addPyFile(path)
    _sent.add(app)
