"""The package for Python workers: sent once per application, so that they need no path of their own."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="cleanloom-")  # the driver serves the file from here until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = os.path.join(folder, "cleanloom-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for at, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(at, name)
                    z.write(full, os.path.join("cleanloom", os.path.relpath(full, root)))
    context.addPyFile(path)
    _SENT.add(context.applicationId)
