from __future__ import annotations

import copy
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lathework.operators import contracts
from lathework.operators import relational as R
from lathework.operators import sampling
from lathework.operators import sequential as S


def digest(x):
    return hashlib.sha256(x.encode()).hexdigest()


def sound():
    """A sample that breaks no rule."""
    d = {
        "source": {"platform": "p", "video_sha256": digest("v"), "native_frame_index": 9, "pts": 9000, "timestamp_ms": 300, "time_base": {"num": 1, "den": 30000}, "frame_rate": {"avg_num": 30, "avg_den": 1, "r_num": 30, "r_den": 1, "is_vfr": False}},
        "image": {"width": 400, "height": 200, "clean_uri": "c", "rendered_uri": "r"},
        "subtitle": {
            "event_id": "e", "text_raw": "x", "text_normalized": "x", "start_native_frame": 5, "end_native_frame_exclusive": 15, "native_duration_frames": 10, "start_pts": 0, "end_pts_exclusive": 1, "start_time_ms": 100, "end_time_ms": 400, "duration_ms": 300,
            "bbox_xyxy": [100, 130, 300, 170], "bbox_normalized": [0.25, 0.65, 0.75, 0.85], "alpha_mask_uri": "a", "inpaint_mask_uri": "i",
            "style": {"font_sha256": digest("f"), "font_size_h_ratio": 0.1, "letter_spacing": 0.0, "line_spacing": 0.0, "stroke_width_h_ratio": 0.0, "opacity": 1.0, "style_seed": 3},
        },
        "transform": {"crop_xywh": [0, 0, 400, 200], "target_size": [400, 200]},
        "build": {"dataset_version": "v1.2", "config_sha256": digest("c"), "renderer_version": "1", "ffmpeg_version": "6", "seed": 1},
        "split": "train",
    }
    return d | {"sample_id": own_id(d)}


def own_id(d):
    s = d["source"]
    fields = {"dataset_version": d["build"]["dataset_version"], "video_sha256": s["video_sha256"], "native_frame_index": s["native_frame_index"], "pts": s["pts"], "crop_xywh": d["transform"]["crop_xywh"], "event_id": d["subtitle"]["event_id"], "style_seed": d["subtitle"]["style"]["style_seed"]}
    return digest(json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False))


def changed(path, value, renew=True):
    d = copy.deepcopy(sound())
    at = d
    *way, last = path.split(".")
    for p in way:
        at = at[p]
    at[last] = value
    return d | {"sample_id": own_id(d)} if renew and path != "sample_id" else d


CASES = [
    ("image.width", 401, {"image has the target size"}),
    ("subtitle.bbox_xyxy", [100, 130, 401, 170], {"box is inside the image", "normalised box is the pixel box"}),
    ("subtitle.bbox_normalized", [0.253, 0.65, 0.75, 0.85], {"normalised box is the pixel box"}),
    ("subtitle.bbox_normalized", [0.2519, 0.65, 0.75, 0.85], set()),
    ("sample_id", digest("other"), {"sample_id is that of its fields"}),
    ("source.timestamp_ms", 301, set()),
    ("source.timestamp_ms", 302, {"time is that of the ticks"}),
    ("subtitle.native_duration_frames", 9, {"number of frames"}),
    ("subtitle.end_pts_exclusive", 0, {"ticks are in order"}),
    ("subtitle.duration_ms", 299, {"duration"}),
    ("build.dataset_version", "1.2", {"dataset version"}),
    ("subtitle.style.opacity", 1.5, {"opacity is within 0 and 1"}),
    ("split", "dev", {"split"}),
    ("source.native_frame_index", -1, {"source.native_frame_index is at least 0"}),
    ("split", None, {"split"}),
]


def test_sample_rules(spark):
    rows = [sound(), *(changed(p, v) for p, v, _ in CASES)]
    low = changed("subtitle.bbox_xyxy", [100, 100, 300, 130])
    low["subtitle"]["bbox_normalized"] = [0.25, 0.5, 0.75, 0.65]
    rows.append(low)
    for r in rows:  # the key of the report, apart from the rules
        r["split"] = r["split"]
    for row, want in zip(rows, [set(), *(w for _, _, w in CASES), {"centre is in its band"}], strict=True):
        one = spark.createDataFrame([row], contracts.schema())
        assert {r.rule for r in contracts.sample_violations(one).collect()} == want
        assert contracts.accepted(one).count() == (not want)


def test_event_rules(spark):
    names = "event_id start_native_frame end_native_frame_exclusive native_duration_frames start_pts end_pts_exclusive start_time_ms end_time_ms duration_ms fade_in_ms fade_out_ms frames_per_event".split()
    rows = [("a", 0, 3, 3, 0, 9, 0, 100, 100, 60, 40, 1), ("b", 0, 3, 3, 0, 9, 0, 100, 100, 61, 40, 4)]
    got = contracts.event_violations(spark.createDataFrame(rows, names)).collect()
    assert {tuple(r) for r in got} == {("b", "fades fit"), ("b", "frames an event")}


def test_numbered_and_nearest(spark):
    df = spark.createDataFrame([(int(k),) for k in [5, 5, 1, 9, 7, 3, 100]] + [(k,) for k in range(1000, 3000)], "k long").repartition(7)
    got = R.numbered(df, "k").collect()
    assert [r.k for r in sorted(got, key=lambda r: r.position)] == sorted(r.k for r in got) and {r.position for r in got} == set(range(2007))
    assert R.numbered(df.limit(0), "k").count() == 0
    left = spark.createDataFrame([(1, 5), (1, 9), (1, 100), (2, 1)], "k int, t int")
    right = spark.createDataFrame([(1, 4, 7), (1, 6, 8), (1, 6, 3), (1, 11, 1), (3, 4, 1)], "k int, t int, v int")
    assert {(r.k, r.t): r.v for r in R.asof_nearest(left, right, "k", "t", "v").collect()} == {(1, 5): 7, (1, 9): 1, (1, 100): 1, (2, 1): None}


def test_hamming_pairs_and_near_clusters(spark):
    import random

    rng = random.Random(3)
    hashes = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(80):
        x = rng.choice(hashes)
        for _ in range(rng.randint(0, 6)):
            x ^= 1 << rng.randrange(64)
        hashes.append(x)
    signed = [(f"i{k:03d}", h - (1 << 64) if h >> 63 else h) for k, h in enumerate(hashes)]
    df = spark.createDataFrame(signed, "id string, hash long")
    for most in (0, 2, 5, 9):
        want = {(a, b, (x ^ y).bit_count()) for i, (a, x) in enumerate(zip([s[0] for s in signed], hashes, strict=True)) for (b, _), y in zip(signed[i + 1 :], hashes[i + 1 :], strict=True) if (x ^ y).bit_count() <= most}
        got = [tuple(r) for r in R.hamming_pairs(df, "id", "hash", most).collect()]
        assert set(got) == want and len(got) == len(want)
        assert {tuple(r) for r in S.near_clusters(df, most).collect()} == set(S.greedy_near(signed, most))


def test_frames_of_events(spark):
    plan = sampling.Plan(frames=3, fade=1.0)
    events = sampling.draw_samples(spark, 30, 8, ["a"], plan)
    got = sampling.event_frames(events, 3, F.lit(50)).collect()
    assert len(got) == 90
    for r in got:
        assert r.frame_time_ms == 50 + round(r.frame * r.duration_ms / 2)
        t = r.frame_time_ms - 50
        want = t / r.fade_in_ms if t < r.fade_in_ms else (r.duration_ms - t) / r.fade_out_ms if t > r.duration_ms - r.fade_out_ms else 1.0
        assert abs(r.effective_opacity - r.opacity * want) < 1e-9
    seen = []
    sampling.draw(1, 8, ["a"], plan, lambda row: seen.append(row["frame"]) or row["frame"] < 2)
    assert seen == [0, 1, 2] * plan.attempts
    for bad in ({"frames": 4}, {"rows": (0.9, 0.1)}, {"durations": [((5, 5), 1.0)]}, {"columns": [((0.1, 0.2), 0.0)]}):
        with pytest.raises(ValueError):
            sampling.Plan(**bad)
    with pytest.raises(ValueError, match="unknown alignment"):
        sampling.Plan(style=sampling.Style(align=[("middle", 1.0)]))


def test_verdicts(spark):
    tracked = spark.createDataFrame([("v", 0, 0, [1, 1, 0]), ("v", 0, 2, [1, 1, 0]), ("v", 1, 0, [1, 0]), ("v", 1, 1, [0, 1]), ("v", 2, 0, [0]), ("v", 2, 1, [0, 0])], "video string, track int, frame int, mask array<int>")
    assert {(r.track, r.switched) for r in S.content_switches(tracked, 0.75).collect()} == {(0, False), (1, True), (2, False)}
    boxes = spark.createDataFrame([("v", "subtitle"), ("v", "watermark")], "video string, role string")
    got = {r.video: (r.subtitle_boxes, r.watermark_boxes, r.subtitle_present) for r in S.video_verdicts(boxes, spark.createDataFrame([("v",), ("w",)], "video string")).collect()}
    assert got == {"v": (1, 1, True), "w": (0, 0, False)}
    events = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z")], "id string, i int, s string")
    assert {(r.id, r.s, r.first) for r in S.last_by_id(events, "id", "i").collect()} == {("a", "z", 1), ("b", "y", 2)}
