"""Carry the package to executors that have no copy of it."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the application's Python files, once an application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        archive = Path(tempfile.mkdtemp(prefix="parcelflow-code-")) / "parcelflow.zip"
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as target:
            for source in sorted(PACKAGE.rglob("*.py")):
                target.write(source, str(source.relative_to(PACKAGE.parent)))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return spark
