"""Sends the package's source to the executors, so that Arrow functions load there from any working folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Add the package as a zip to the application, once. Spark serves the driver's copy to all executors."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parent
    handle, path = tempfile.mkstemp(prefix="tagmill-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(path, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, str(source.relative_to(package.parent)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)
