"""Distribution reports: statistics that are zero on no rows, buckets against targets, and a verdict in words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lathework.functions.timebase import aspect_label, size_label
from lathework.operators.relational import bucket_histogram


def spread(name: str) -> list[Column]:
    c = F.col(name).cast("double")
    return [F.coalesce(f(c), F.lit(0.0)).alias(f"{name}_{n}") for f, n in ((F.min, "min"), (F.max, "max"), (F.avg, "mean"))]


def samples(df: DataFrame) -> DataFrame:
    """One row: size, number of configurations, strict pairs, and the spread of sizes and positions."""
    return df.agg(F.count("*").alias("n_samples"), F.countDistinct("config_sha256").alias("unique_configs"), F.count_if("pairing_ok").alias("pairing_ok"), *spread("font_size"), *spread("x"), *spread("y"))


def durations(df: DataFrame, value: str, targets: DataFrame, tolerance: float) -> DataFrame:
    return bucket_histogram(df, value, targets).withColumn("within", F.abs("deviation") <= tolerance)


def verdict(buckets: DataFrame, n: int, least: int) -> str:
    """What is out of tolerance, in bucket order. Buckets are a few configured rows."""
    issues = [f"{n} samples are fewer than {least}"] if n < least else []
    issues += [f"bucket {r.lo}-{r.hi} ms deviates by {r.deviation:+.3f}" for r in buckets.where("not within").orderBy("lo", "hi").collect()]
    return "; ".join(issues) or "all buckets within tolerance"


def frames(df: DataFrame, by: str) -> DataFrame:
    """By video: frames, distinct images, time span, most frequent size and aspect, and whether ticks never fall."""
    size, aspect = size_label(F.col("target_width"), F.col("target_height")), aspect_label(F.col("target_width"), F.col("target_height"))
    prior = F.lag("pts").over(W.partitionBy(by).orderBy("position"))
    marked = df.withColumn("_ok", F.coalesce(F.col("pts") >= prior, F.lit(True))).withColumn("_size", size).withColumn("_aspect", aspect)
    return marked.groupBy(by).agg(
        F.count("*").alias("n_frames"), F.countDistinct("image_sha256").alias("unique_images"), (F.max("timestamp_ms") - F.min("timestamp_ms")).alias("span_ms"),
        F.mode("_size").alias("size"), F.mode("_aspect").alias("aspect"), F.bool_and("_ok").alias("monotone"),
    )
