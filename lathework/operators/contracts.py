"""Contracts of samples and events: every rule as a column, checked in one pass over the nested records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lathework.functions import ids
from lathework.functions.timebase import ticks_to_ms
from lathework.operators.relational import violations

#: Band of a visible centre's height, and how far normalised sides may be from the pixels'.
BAND, NEAR = (0.60, 0.90), 0.002
#: Fixed formats of a digest, a version and a split.
DIGEST, VERSION, SPLITS = "^[0-9a-f]{64}$", r"^v\d+(\.\d+)*$", ("train", "val", "test")

#: Shape of a nested sample.
SAMPLE = (
    "sample_id string, source struct<platform: string, video_sha256: string, creator_hash: string, content_cluster_id: string, native_frame_index: long, pts: long, timestamp_ms: long, "
    "time_base: struct<num: long, den: long>, frame_rate: struct<avg_num: long, avg_den: long, r_num: long, r_den: long, is_vfr: boolean>>, "
    "image struct<width: long, height: long, clean_uri: string, rendered_uri: string>, "
    "subtitle struct<event_id: string, text_raw: string, text_normalized: string, start_native_frame: long, end_native_frame_exclusive: long, start_pts: long, end_pts_exclusive: long, "
    "start_time_ms: long, end_time_ms: long, duration_ms: long, native_duration_frames: long, bbox_xyxy: array<long>, bbox_normalized: array<double>, line_bboxes_xyxy: array<array<long>>, "
    "polygon: array<array<double>>, alpha_mask_uri: string, inpaint_mask_uri: string, style: struct<font_sha256: string, font_size_h_ratio: double, letter_spacing: double, "
    "line_spacing: double, stroke_width_h_ratio: double, opacity: double, style_seed: long>>, "
    "transform struct<crop_xywh: array<long>, target_size: array<long>>, "
    "build struct<dataset_version: string, config_sha256: string, renderer_version: string, ffmpeg_version: string, seed: long>, split string"
)


def schema(text: str = SAMPLE) -> T.StructType:
    return T._parse_datatype_string(text)


def ordered(box: Column) -> Column:
    """A box with a right side beyond the left and a bottom below the top."""
    return (F.get(box, 2) > F.get(box, 0)) & (F.get(box, 3) > F.get(box, 1))


def span(low: str, high: str, length: str | None = None) -> Column:
    """A half-open interval that is not empty and, if given, as long as it says."""
    a, z = F.col(low), F.col(high)
    return z > a if length is None else F.col(length) == z - a


def interval_rules(at: str = "") -> dict[str, Column]:
    """Intervals of an event in frames, ticks and milliseconds."""
    return {
        "frames are in order": span(f"{at}start_native_frame", f"{at}end_native_frame_exclusive"),
        "number of frames": span(f"{at}start_native_frame", f"{at}end_native_frame_exclusive", f"{at}native_duration_frames"),
        "ticks are in order": span(f"{at}start_pts", f"{at}end_pts_exclusive"),
        "times are in order": span(f"{at}start_time_ms", f"{at}end_time_ms"),
        "duration": span(f"{at}start_time_ms", f"{at}end_time_ms", f"{at}duration_ms"),
    }


def event_rules(at: str = "") -> dict[str, Column]:
    """Rules of a generated event: its intervals, fades that fit into it, and 1 to 3 frames."""
    return interval_rules(at) | {
        "fades fit": F.col(f"{at}fade_in_ms") + F.col(f"{at}fade_out_ms") <= F.col(f"{at}duration_ms"),
        "frames an event": F.col(f"{at}frames_per_event").between(1, 3),
    }


def domain_rules() -> dict[str, Column]:
    """What single values may be."""
    c = F.col
    whole = "source.native_frame_index source.timestamp_ms subtitle.start_native_frame subtitle.end_native_frame_exclusive subtitle.start_time_ms subtitle.end_time_ms subtitle.style.style_seed build.seed"
    above = "image.width image.height subtitle.duration_ms subtitle.native_duration_frames source.time_base.num source.time_base.den source.frame_rate.avg_den source.frame_rate.r_den subtitle.style.font_size_h_ratio"
    free = "source.frame_rate.avg_num source.frame_rate.r_num subtitle.style.letter_spacing subtitle.style.line_spacing subtitle.style.stroke_width_h_ratio"
    digests = "sample_id source.video_sha256 subtitle.style.font_sha256 build.config_sha256"
    least = lambda box, n: F.forall(F.slice(box, 1, 2), lambda x: x >= 0) & F.forall(F.slice(box, 3, 2), lambda x: x > 0) & (F.size(box) == n)
    return (
        {f"{n} is at least 0": c(n) >= 0 for n in f"{whole} {free}".split()}
        | {f"{n} is above 0": c(n) > 0 for n in above.split()}
        | {f"{n} is a digest": c(n).rlike(DIGEST) for n in digests.split()}
        | {
            "opacity is within 0 and 1": c("subtitle.style.opacity").between(0, 1),
            "normalised box is within 0 and 1": F.forall("subtitle.bbox_normalized", lambda x: (x >= 0) & (x <= 1)) & (F.size("subtitle.bbox_normalized") == 4),
            "pixel box": least(c("subtitle.bbox_xyxy"), 4),
            "crop": least(c("transform.crop_xywh"), 4),
            "dataset version": c("build.dataset_version").rlike(VERSION),
            "split": c("split").isin(*SPLITS),
        }
    )


def sample_rules() -> dict[str, Column]:
    """Rules of a nested sample that tie its parts together."""
    c = F.col
    wide, high, target = c("image.width"), c("image.height"), c("transform.target_size")
    px, norm = c("subtitle.bbox_xyxy"), c("subtitle.bbox_normalized")
    share = F.transform(px, lambda x, i: x / F.when(i % 2 == 0, wide).otherwise(high))
    inside = (F.get(px, 0) >= 0) & (F.get(px, 1) >= 0) & (F.get(px, 2) <= wide) & (F.get(px, 3) <= high)
    own = ids.sample_id(c("build.dataset_version"), c("source.video_sha256"), c("source.native_frame_index"), c("source.pts"), c("transform.crop_xywh"), c("subtitle.event_id"), c("subtitle.style.style_seed"))
    ms = ticks_to_ms(c("source.pts"), c("source.time_base.num"), c("source.time_base.den"))
    return {
        "image has the target size": (wide == F.get(target, 0)) & (high == F.get(target, 1)),
        "box is inside the image": inside & ordered(px),
        "normalised box is the pixel box": F.forall(F.zip_with(norm, share, lambda a, b: F.abs(a - b) <= NEAR), lambda ok: ok),
        "centre is in its band": ((F.get(px, 1) + F.get(px, 3)) / 2 / high).between(*BAND),
        "sample_id is that of its fields": c("sample_id") == own,
        "time is that of the ticks": F.abs(c("source.timestamp_ms") - ms) <= 1,
        **interval_rules("subtitle."),
        "normalised box is in order": ordered(norm),
        "pixel box is in order": ordered(px),
    }


def sample_violations(samples: DataFrame, *, domains: bool = True) -> DataFrame:
    """``id, rule`` for each rule that a nested sample breaks; what is missing breaks the rules that need it."""
    return violations(samples, "sample_id", sample_rules() | (domain_rules() if domains else {}))


def event_violations(events: DataFrame) -> DataFrame:
    return violations(events, "event_id", event_rules())


def accepted(samples: DataFrame) -> DataFrame:
    """Samples that break no rule."""
    ok = [F.coalesce(rule, F.lit(False)) for rule in (sample_rules() | domain_rules()).values()]
    return samples.where(F.forall(F.array(*ok), lambda x: x))
