"""Make this package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application (``addPyFile``)."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.dirname(root)
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera_sources.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, base))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
