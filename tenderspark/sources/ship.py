"""Brings this package to the Python workers of a cluster that does not have it installed."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

_DONE: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds a zip of the package to the application, once; Spark hands it to every executor, later ones too."""
    sc = spark.sparkContext
    if sc.applicationId in _DONE:
        return
    root = Path(__file__).resolve().parents[1]
    if root.is_dir():  # not itself imported from a zip
        base = Path(tempfile.mkdtemp(prefix="tenderspark-")) / "tenderspark"
        sc.addPyFile(shutil.make_archive(str(base), "zip", root_dir=root.parent, base_dir=root.name))
    _DONE.add(sc.applicationId)
