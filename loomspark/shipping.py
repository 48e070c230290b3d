"""This package for the executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Give executors this package, once per application; what runs in Python workers needs it wherever it isn't installed."""
    sc = spark.sparkContext
    if getattr(sc, "_loomspark_shipped", False):
        return
    root = Path(__file__).resolve().parent
    to = os.path.join(tempfile.mkdtemp(prefix="loomspark-"), "loomspark_src.zip")
    with zipfile.ZipFile(to, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(to)  # the driver copies it to where executors fetch it from
    sc._loomspark_shipped = True


def active() -> None:
    """``ship`` for the session in use, for functions that only get columns; nothing within a task."""
    from pyspark import TaskContext

    if TaskContext.get() is None and (spark := SparkSession.getActiveSession()):
        ship(spark)
