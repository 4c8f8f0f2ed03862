"""Temporal multimodal analytics as composable PySpark DataFrame operators."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends the package to the executors once, for operators that run Python there. Not needed after --py-files."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).parent
    handle, path = tempfile.mkstemp(prefix="cuesheet-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
