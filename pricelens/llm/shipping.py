"""Makes this package importable in the executors' Python workers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import pricelens
from pricelens.session import configure


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and its modules shipped once per application."""
    configure(spark)
    context = spark.sparkContext
    if not getattr(context, "_pricelens_shipped", False):
        root = os.path.dirname(os.path.abspath(pricelens.__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="pricelens-"), "pricelens_modules.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.join("pricelens", os.path.relpath(path, root)))
        context.addPyFile(archive)
        context._pricelens_shipped = True
    return spark
