"""Gives the executors this package, so that Python functions find their modules there."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Adds the package as an archive, once a context: the executors need not have it installed."""
    sc = spark.sparkContext
    if getattr(sc, "_lathework_shipped", False):
        return
    top = Path(__file__).resolve().parent
    with zipfile.ZipFile(archive := f"{tempfile.mkdtemp(prefix='lathework-')}/lathework.zip", "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(archive)
    sc._lathework_shipped = True
