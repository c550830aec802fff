"""Readers: JSON manifests, text corpora, frame logs, images; a Python data source for item manifests over HTTP or files."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from urllib.parse import urljoin
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from lathework.functions.text import BLANKS
from lathework.functions.timebase import ticks_to_ms


def json_objects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Multi-line JSON objects with a schema; what can't be parsed fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def corpus(lines: DataFrame, column: str = "value") -> DataFrame:
    """Stripped lines that are neither blank nor comments."""
    line = F.btrim(F.col(column), F.lit(BLANKS))
    return lines.select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#"))


def images(spark: SparkSession, folder: str) -> DataFrame:
    """Decoded PNG files of a folder by path: height, width, channels, data (rows of blue, green, red)."""
    return spark.read.format("image").option("pathGlobFilter", "*.png").load(folder).select("image.*").withColumnRenamed("origin", "path")


def files_with_digest(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").load(glob).select("path", "length", F.sha2("content", 256).alias("sha256"))


def frame_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Frame number, ticks and seconds of the lines of a frame log that have all three."""
    part = lambda name, kind: F.regexp_extract(column, rf"\b{name}:\s*({kind})", 1)
    rows = lines.where(F.col(column).rlike(r"\bn:\s*\d+.*\bpts:\s*\d+.*\bpts_time:\s*[\d.]+"))
    return rows.select(part("n", r"\d+").cast("long").alias("n"), part("pts", r"\d+").cast("long").alias("pts"), part("pts_time", r"[\d.]+").cast("double").alias("pts_time"))


def timeline(frames: DataFrame, num: int, den: int) -> DataFrame:
    return frames.withColumn("timestamp_ms", ticks_to_ms(F.col("pts"), F.lit(num), F.lit(den)))


def split_pngs(stream: bytes) -> Iterator[bytes]:
    """Images of a stream of concatenated PNG files: chunk after chunk up to each end mark."""
    at = 0
    while at < len(stream):
        if stream[at : at + 8] != b"\x89PNG\r\n\x1a\n":
            raise ValueError(f"no PNG at byte {at}")
        start, at = at, at + 8
        kind = b""
        while kind != b"IEND":
            if at + 8 > len(stream):
                raise ValueError("the last PNG is cut off")
            size, kind = struct.unpack(">I4s", stream[at : at + 8])
            at += 12 + size
        yield stream[start:at]


class ItemManifest(DataSource):
    """``spark.read.format("item_manifest").load(url)``: items of a manifest.json, a partition for each given url.

    Options: ``path`` (urls, comma-separated), ``source_id``.
    """

    @classmethod
    def name(cls) -> str:
        return "item_manifest"

    def schema(self) -> str:
        return "source_id string, item_id string, url string, title string"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return _ManifestReader(self.options)


class _ManifestReader(DataSourceReader):
    def __init__(self, options):
        self.urls = [u for u in options.get("path", "").split(",") if u]
        self.source = options.get("source_id", "")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(u) for u in self.urls]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        base = partition.value.rstrip("/")
        with urlopen(base if base.endswith(".json") else base + "/manifest.json", timeout=10) as f:
            for item in json.load(f).get("items", []):
                yield self.source, str(item["item_id"]), urljoin(base, str(item.get("url", ""))), item.get("title")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(ItemManifest)
