"""Bring this package to the executors, for sessions that were started without it on their path."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from pathlib import Path
from threading import Lock

from pyspark.sql import SparkSession

_shipped: set[str] = set()
_once = Lock()


def ship_package(spark: SparkSession) -> None:
    """Add the package's sources to the session's Python files, once for each application."""
    context = spark.sparkContext
    with _once:
        if context.applicationId in _shipped:
            return
        package = Path(__file__).resolve().parent.parent
        # Spark copies the archive from the driver to every executor that needs it.
        folder = tempfile.mkdtemp(prefix="ledgermill-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        archive = os.path.join(folder, "ledgermill_sources.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
