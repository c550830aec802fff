"""Nested records to flat tables: samples, events, and frames, scenes and failures of an ingest manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at(path: str, i: int, default: float | int = 0) -> Column:
    """Item of an array column, or the default where array or item is missing."""
    return F.coalesce(F.get(F.col(path), i), F.lit(default))


def flat_samples(samples: DataFrame, *, with_event: bool = False) -> DataFrame:
    """A row of 65 columns per sample, and its event and frame if asked for; missing points and boxes are zeros, a
    missing split is empty, a missing map has no entries."""
    plain = "sample_index sample_seed duration_ms text text_normalized normalization_version language script font_id font_sha256 fallback_used".split()
    style = "font_ids font_size_h_ratio letter_spacing_px line_spacing_px stroke_width_h_ratio opacity align fill_color stroke_color shadow_color shadow_offset_xy shadow_blur_px language direction rotation_degrees".split()
    effect = [at("effect_bbox_xyxy", i).alias(f"effect_bbox_{c}") for i, c in enumerate(("x0", "y0", "x1", "y1"))]
    crop = [at("transform.crop_xywh", i).alias(f"transform_crop_{c}") for i, c in enumerate("xywh")]
    target = [at("transform.target_size", i).alias(f"transform_target_{c}") for i, c in enumerate(("width", "height"))]
    build = [F.col(f"build.{c}").alias(f"build_{c}") for c in ("dataset_version", "config_sha256", "renderer_version", "ffmpeg_version", "seed")]
    source = [F.col(f"source.{c}").alias(f"source_{c}") for c in ("platform", "video_sha256", "creator_hash", "native_frame_index", "pts", "timestamp_ms")]
    rates = [F.col(f"source.{a}.{b}").alias(f"source_{n}") for a, b, n in (
        ("time_base", "num", "time_base_num"), ("time_base", "den", "time_base_den"), ("frame_rate", "avg_num", "avg_num"), ("frame_rate", "avg_den", "avg_den"),
        ("frame_rate", "r_num", "r_num"), ("frame_rate", "r_den", "r_den"), ("frame_rate", "is_vfr", "is_vfr"),
    )]
    return samples.select(
        *plain, F.coalesce("missing_chars", F.create_map().cast("map<string,array<string>>")).alias("missing_chars"), at("center", 0, 0.0).alias("center_x"), at("center", 1, 0.0).alias("center_y"),
        *effect, "line_bboxes_xyxy", "config_sha256", "pairing_ok", "text_policy_ok", F.coalesce("split", F.lit("")).alias("split"), *(F.col(f"style.{c}").alias(f"style_{c}") for c in style),
        F.col("style.background_bar").isNotNull().alias("style_background_bar"), "effective_opacity", "polygon", *source, *rates, *crop, *target, *build,
        *((F.col("event.event_id").alias("event_id"), F.col("event_frame_index")) if with_event else ()),
    )


def flat_events(events: DataFrame) -> DataFrame:
    plain = "event_id text_raw text_normalized normalization_version start_time_ms end_time_ms duration_ms start_pts end_pts_exclusive start_native_frame end_native_frame_exclusive native_duration_frames frames_per_event fade_in_ms fade_out_ms".split()
    return events.select(*plain, *(F.col(f"style.{c}").alias(f"style_{c}") for c in ("font_ids", "font_size_h_ratio", "align")), F.col("style.language").alias("language"))


def flat_manifest(manifest: DataFrame) -> dict[str, DataFrame]:
    """Frames with the fields of their video, scenes, and failures of ingest manifests."""
    video = F.col("probe.video")
    frames = manifest.select("video_sha256", video.alias("v"), F.explode("frames").alias("f")).select(
        "video_sha256", *(F.col(f"f.{c}").alias(c) for c in ("scene_index", "native_frame_index", "pts", "pts_time_seconds", "timestamp_ms")),
        *(at("f.crop_xywh", i).alias(f"crop_{c}") for i, c in enumerate("xywh")), *(at("f.target_size", i).alias(f"target_{c}") for i, c in enumerate(("width", "height"))),
        "f.crop_mode", "f.uri", "f.image_sha256", F.col("v.width").alias("source_width"), F.col("v.height").alias("source_height"),
        F.col("v.time_base.num").alias("time_base_num"), F.col("v.time_base.den").alias("time_base_den"),
        *(F.col(f"v.avg_frame_rate.{c}").alias(c) for c in ("avg_num", "avg_den")), *(F.col(f"v.r_frame_rate.{c}").alias(c) for c in ("r_num", "r_den")), "v.is_vfr",
    )
    scenes = manifest.select("video_sha256", F.explode("scenes").alias("s")).select("video_sha256", "s.*")
    return {"frames": frames, "scenes": scenes, "failures": manifest.select(F.explode("failures").alias("x")).select("x.*")}


def dedup_items(manifest: DataFrame) -> DataFrame:
    """A row for each video and each of its frames, with ids made from their digests."""
    video = manifest.select(F.concat(F.lit("video:"), "video_sha256").alias("id"), F.col("video_sha256").alias("sha256"), F.col("video_sha256").alias("group_id"))
    frame = manifest.select("video_sha256", F.explode("frames").alias("f")).select(F.concat_ws(":", F.lit("frame"), "video_sha256", "f.uri").alias("id"), F.col("f.image_sha256").alias("sha256"), F.col("video_sha256").alias("group_id"))
    return video.unionByName(frame)


def sources_and_transforms(manifest: DataFrame, platform: str, creator_hash: str | None = None) -> DataFrame:
    """For each frame of ingest manifests where it comes from and how it was cut: ``uri, source, transform``."""
    v = F.col("probe.video")
    return manifest.select("video_sha256", v.alias("v"), F.explode("frames").alias("f")).select(
        "f.uri",
        F.struct(
            F.lit(platform).alias("platform"), F.col("video_sha256"), F.lit(creator_hash).cast("string").alias("creator_hash"), F.col("f.native_frame_index"), F.col("f.pts"), F.col("f.timestamp_ms"),
            F.col("v.time_base"), F.struct("v.avg_frame_rate.avg_num", "v.avg_frame_rate.avg_den", "v.r_frame_rate.r_num", "v.r_frame_rate.r_den", "v.is_vfr").alias("frame_rate"),
        ).alias("source"),
        F.struct("f.crop_xywh", "f.target_size").alias("transform"),
    )


def strict_zip(*columns: Column) -> Column:
    """Arrays item by item as structs; arrays of different lengths fail while running."""
    same = [F.size(c) == F.size(columns[0]) for c in columns[1:]]
    names = [F.when(F.forall(F.array(*same), lambda ok: ok), c).otherwise(F.raise_error(F.lit("arrays differ in length")).cast("array<string>")) if i == 0 and same else c for i, c in enumerate(columns)]
    return F.arrays_zip(*names)
