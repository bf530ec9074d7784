"""Send this package to the executors that run its functions."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_sent: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the session's Python files, once per application.

    So tasks can import it wherever the executors run. The archive is made on the
    driver and served by Spark, which keeps its own copy; executors read no folder of
    the driver. The session's settings are left alone: operators cut the batches they
    get (``arrays.blocks``), and Spark bounds a batch by its bytes.
    """
    context = spark.sparkContext
    if context.applicationId not in _sent:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="package-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        target = os.path.join(folder, "stationflow_package.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, files in os.walk(top):
                for name in files:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(top)))
        context.addPyFile(target)
        _sent.add(context.applicationId)
    return spark
