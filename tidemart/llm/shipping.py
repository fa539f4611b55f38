"""The package on the executors' Python path, for sessions started without ``--py-files``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give every executor this package, once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    folder = tempfile.mkdtemp(prefix="package-")  # Spark serves the file until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{PACKAGE.name}-{application}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(PACKAGE.rglob("*.py")):
            out.write(path, path.relative_to(PACKAGE.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)
