"""Giving the package to Python workers of executors that do not have it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import resma

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package, zipped, to the session's Python files; once per application."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    root = os.path.dirname(os.path.abspath(resma.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="resma-"), "resma.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    # the driver hands the file to every executor
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)
