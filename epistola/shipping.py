"""Sends the package to the executors, so that their Python workers can import it wherever the driver started."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package's sources to the application once; Spark serves them to every executor, also to those that come later."""
    app = spark.sparkContext.applicationId
    if app in _SENT:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    place = os.path.join(tempfile.mkdtemp(prefix="epistola-"), "epistola.zip")
    with zipfile.ZipFile(place, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), os.path.dirname(root)))
    spark.sparkContext.addPyFile(place)
    _SENT.add(app)
