"""What a session needs before this package's Python functions run on its executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes that a batch of rows takes to a Python worker; long texts would else come ten thousand at a time.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def _bounded(spark: SparkSession) -> None:
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, "8m")


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once an application; workers there needn't find it on a path of their own."""
    _bounded(spark)
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    folder_of_zip = tempfile.mkdtemp(prefix="gridloom-")
    atexit.register(shutil.rmtree, folder_of_zip, ignore_errors=True)
    path = os.path.join(folder_of_zip, "gridloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("gridloom", os.path.relpath(full, here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
