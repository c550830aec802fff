"""Media descriptions: probe JSON, scenes from cut times, representative frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lathework.functions.timebase import even_picks, is_variable_rate, parse_fraction
from lathework.operators.relational import asof_forward

#: Fixed shape of the probe's JSON, as far as it is read.
PROBE = (
    "struct<format: struct<format_name: string, duration: string>, streams: array<struct<index: long, codec_type: string, codec_name: string, width: long, height: long, "
    "avg_frame_rate: string, r_frame_rate: string, time_base: string, duration: string, nb_frames: string, pix_fmt: string>>>"
)


def probe(c: Column) -> Column:
    """First video stream and container of a probe's JSON; null without a video stream."""
    p = F.from_json(c, PROBE)
    v = F.get(F.filter(p["streams"], lambda s: s["codec_type"] == "video"), 0)
    avg, rate, base = (parse_fraction(v[n]) for n in ("avg_frame_rate", "r_frame_rate", "time_base"))
    base = F.struct(F.coalesce(F.nullif(base["num"], F.lit(0).cast("long")), F.lit(1).cast("long")).alias("num"), base["den"].alias("den"))
    variable = is_variable_rate(avg["num"], avg["den"], rate["num"], rate["den"])
    out = F.struct(
        p["format"]["format_name"].alias("format_name"), p["format"]["duration"].try_cast("double").alias("duration_seconds"), v["codec_name"].alias("codec_name"), v["width"].alias("width"),
        v["height"].alias("height"), v["nb_frames"].try_cast("long").alias("nb_frames"), avg.alias("avg_frame_rate"), rate.alias("r_frame_rate"), base.alias("time_base"), variable.alias("is_vfr"),
    )
    return F.when(v.isNotNull(), out)


def scenes(cuts: DataFrame, frames: DataFrame, ends: DataFrame) -> DataFrame:
    """Scenes between cuts (video, t), with 0 and the end (video, t) as outer bounds, in frames (video, n, t).

    A bound is the first frame at or after its time; beyond the last frame it is their number. A scene has one frame at
    least, and does not begin after the last frame.
    """
    bounds = ends.select("video", F.lit(0.0).alias("t")).unionByName(cuts.select("video", "t")).unionByName(ends.select("video", "t"))
    counted = frames.groupBy("video").agg(F.count("*").alias("total"))
    placed = asof_forward(bounds, frames, "video", "t", "n").join(counted, "video").withColumn("n", F.coalesce("n", "total"))
    ordered = placed.groupBy("video", "total").agg(F.array_sort(F.collect_list(F.struct("t", "n"))).alias("b"))
    pairs = ordered.select("video", "total", F.posexplode(F.arrays_zip(F.slice("b", F.lit(1), F.size("b") - 1).alias("a"), F.slice("b", F.lit(2), F.size("b") - 1).alias("z"))).alias("scene", "p"))
    first = F.least(F.col("p.a.n"), F.col("total") - 1)
    return pairs.select("video", "scene", first.alias("start_frame"), F.greatest(F.col("p.z.n"), first + 1).alias("end_frame"))


def representative_frames(start: Column, end: Column, count: int) -> Column:
    """Frames of a scene to keep: the middle one, or evenly spread ones with both ends."""
    n = end - start
    if count == 1:
        return F.array(start + F.floor(n / 2))
    return F.when(n == 1, F.array(start)).otherwise(F.transform(even_picks(n, count), lambda i: i + start))
