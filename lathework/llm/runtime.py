"""Shared-folder tables and Arrow limits used by every operator of this subpackage."""

from __future__ import annotations

import ctypes
import mmap
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from lathework.shipping import ship
from lathework.tables import shared_dir

#: Bytes of one Arrow batch handed to a Python worker; long texts shrink the rows of a batch, never the text.
ARROW_BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package and bound Arrow batches by bytes, unless the session already does."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(key, "2147483647")).rstrip("bB") or 0) > ARROW_BATCH_BYTES:
        spark.conf.set(key, str(ARROW_BATCH_BYTES))


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, after which a worker gives its memory back: Spark keeps idle workers for the next tasks."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from lathework.llm import vec

        try:
            yield from run(batches)
        finally:
            vec.forget()
            pa.default_memory_pool().release_unused()
            ctypes.CDLL(None).malloc_trim(0)

    return df.mapInArrow(lean, schema)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/lathework-{uuid.uuid4().hex}/{name}"
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.deleteOnExit(jpath.getParent())
    return path


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends there, and a lost executor re-reads it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table of ``new_path`` that nothing reads any more."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def put_file(folder: str, name: str, data: bytes) -> None:
    """Write a file of a shared folder from any task: under a name of its own first, so a repeated task does no harm."""
    fs, path = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(path)
    mine = f"{path}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(mine) as f:
        f.write(data)
    fs.move(mine, f"{path}/{name}")


@lru_cache(64)
def _folder(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def map_file(folder: str, name: str) -> np.ndarray:
    """Bytes of a shared file, memory-mapped; from a store that can't be mapped, by a local copy that has no name.

    No file and an empty one give no bytes.
    """
    fs, path = _folder(folder)
    if isinstance(fs, pyarrow.fs.LocalFileSystem):
        try:
            handle = os.open(f"{path}/{name}", os.O_RDONLY)
        except FileNotFoundError:
            return np.zeros(0, np.uint8)
        try:
            if not (size := os.fstat(handle).st_size):
                return np.zeros(0, np.uint8)
            return np.frombuffer(mmap.mmap(handle, size, access=mmap.ACCESS_READ), np.uint8)
        finally:
            os.close(handle)
    if not fs.get_file_info(f"{path}/{name}").size:
        return np.zeros(0, np.uint8)
    with tempfile.TemporaryFile() as copy, fs.open_input_stream(f"{path}/{name}") as f:
        while part := f.read(1 << 20):
            copy.write(part)
        copy.flush()
        return np.frombuffer(mmap.mmap(copy.fileno(), 0, access=mmap.ACCESS_READ), np.uint8)
