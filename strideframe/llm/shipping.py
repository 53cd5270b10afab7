"""Make this package importable in Spark's Python workers where it is not installed there."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the workers of this application, once. Spark copies the file to every executor."""
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(package)
    target = os.path.join(tempfile.mkdtemp(prefix=f"{name}-ship-"), f"{name}_workers.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(package):
            for file in sorted(files):
                if file.endswith(".py"):
                    full = os.path.join(folder, file)
                    out.write(full, os.path.join(name, os.path.relpath(full, package)))
    spark.sparkContext.addPyFile(target)
    _sent.add(app)
