"""Where intermediate tables go: the folder that driver and executors share."""

from __future__ import annotations

import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the context's; a temporary folder only in local mode, where nothing else is at hand."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = Path(tempfile.mkdtemp(prefix="lathework-")).as_uri()
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The frame without its lineage, kept in the shared folder, so a lost executor reads it again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
