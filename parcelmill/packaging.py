"""Sends this package to the Python workers of a cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make ``import parcelmill`` work in every Python worker of the session.

    Operators that run Python in tasks refer to functions of this package, so
    executors need it even when it is installed on the driver only. The zip
    goes through Spark's own file distribution, once per application.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "parcelmill.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(target)
    _shipped.add(context.applicationId)
