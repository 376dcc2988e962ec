"""Python workers get this library from the driver."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_MARK = "_modspark_shipped"


def ship_library(spark: SparkSession) -> None:
    """Send the package to the executors, once per context, for functions that run in Python workers.

    The archive is made in the driver's own folder and handed out by Spark, so no path has to be
    shared; where the library is installed on the workers, the archive holds the same files.
    """
    context = spark.sparkContext
    if getattr(context, _MARK, False):
        return
    package = Path(__file__).resolve().parent
    archive = os.path.join(tempfile.mkdtemp(prefix="modspark-code-"), "modspark_code.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, str(path.relative_to(package.parent)))
    context.addPyFile(archive)
    setattr(context, _MARK, True)
