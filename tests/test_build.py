from __future__ import annotations

import hashlib
import json
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lathework.functions import png
from lathework.operators import sampling
from lathework.operators import vision as V
from lathework.plans import build as B


class Still:
    """A made-up video of 30 frames whose second half is brighter; the path says what goes wrong."""

    def __init__(self, path):
        self.path = path

    def sha256(self):
        return hashlib.sha256(self.path.encode()).hexdigest()

    def probe(self):
        rate = {"avg_num": 10, "avg_den": 1}
        return {"duration_seconds": 3.0, "video": {"width": 64, "height": 48, "time_base": {"num": 1, "den": 1000}, "avg_frame_rate": rate, "r_frame_rate": {"r_num": 10, "r_den": 1}, "is_vfr": False}}

    def timeline(self):
        return [(i, 100 * i if self.path != "falling" else -i, i / 10) for i in range(30)]

    def cuts(self, threshold):
        return [1.5]

    def pngs(self, frames):
        if self.path == "broken" and frames[0] > 15:
            return b""
        return b"".join(png.encode(np.full((48, 64, 3), 40 if k < 15 else 90, np.uint8)) for k in frames)


SMALL = B.Ingest(targets=((320, 240, 1.0),))
PLAN = sampling.Plan(frames=2, style=sampling.Style(rotation=0.0), rows=(0.7, 0.8), columns=[((0.45, 0.55), 1.0)])


def test_png():
    rng = np.random.default_rng(4)
    for c in (1, 3, 4):
        image = rng.integers(0, 256, (7, 9, c), dtype=np.uint8)
        assert (png.decode(png.encode(image)) == image).all()
    with pytest.raises(ValueError):
        png.decode(b"no")


def test_frames_in_order_from_one_pass():
    got = B.frames_of(Still("v"), [20, 3, 20])
    assert [int(x[0, 0, 0]) for x in got] == [90, 40, 90] and B.frames_of(Still("v"), []) == []
    with pytest.raises(ValueError, match="the decoder gave 0"):
        B.frames_of(Still("broken"), [20])


def test_resize_and_picks():
    flat = np.full((20, 30, 3), 77, np.uint8)
    assert (V.resize(flat, 8, 9) == 77).all() and V.resize(flat, 40, 60).shape == (40, 60, 3)
    ramp = np.tile(np.linspace(0, 255, 90).astype(np.uint8), (16, 1))
    assert V.difference_hash(ramp) == "f" * 16 and V.difference_hash(ramp[:, ::-1]) == "0" * 16
    assert V.foreground(np.zeros((5, 5, 3), np.uint8), (9, 9, 12, 12)).shape == (1, 1)
    assert (B.picks(0, 10, 1), B.picks(0, 10, 3), B.picks(4, 6, 5), B.picks(3, 4, 2)) == ([5], [0, 4, 9], [4, 5], [3])
    assert B.scene_bounds([0.0, 0.1, 0.2], [0.15], 0.3) == [(0, 2), (2, 3)]
    assert B.middle_crop(100, 50, 1, 1) == (25, 0, 75, 50)


def test_ingest_keeps_failures_apart(spark, tmp_path):
    rows = {r.video: r for r in B.ingest(spark, ["v", "falling", "broken"], Still, SMALL, str(tmp_path)).collect()}
    assert "fall" in rows["falling"].error and rows["v"].error is None
    good, bad = (json.loads(rows[k].manifest) for k in ("v", "broken"))
    assert [f["native_frame_index"] for f in good["frames"]] == [7, 22] and not good["failures"]
    assert len(bad["frames"]) == 1 and bad["failures"][0]["error_type"] == "ValueError"
    for f in good["frames"]:
        data = (tmp_path / f["uri"]).read_bytes()
        assert hashlib.sha256(data).hexdigest() == f["image_sha256"] and png.decode(data).shape == (240, 320, 3)


def test_build_resumes(spark, tmp_path):
    config = B.Build(events=4, ingest=SMALL, plan=PLAN, corpus=("ab", "cd ef"))
    sources = spark.createDataFrame([("s", "authorized", True, True, True, None, None), ("t", "unknown", True, True, True, None, None)], "source_id string, license_status string, allowed_to_download boolean, allowed_for_derivative_work boolean, allowed_for_ml_training boolean, authorization_start_at date, authorization_expire_at date")
    with pytest.raises(PermissionError, match="license"):
        B.build(spark, ["v"], Still, config, tmp_path / "x", sources=sources, source_id="t")
    run = B.build(spark, ["v"], Still, config, tmp_path, sources=sources, source_id="s")
    assert {s.status for s in run.stages.values()} == {"done"}
    records = spark.read.parquet(f"{tmp_path}/parquet/samples")
    assert records.count() == 8 and spark.read.parquet(f"{tmp_path}/parquet/frames").count() == 2
    for r in records.where(F.col("frame").isNotNull()).collect():
        own = Path(tmp_path) / f"samples/{r.sample_index * 2 + r.frame:05d}"
        doc = json.loads((own / "sample.json").read_text())
        image, mask = png.decode((own / "rendered.png").read_bytes()), png.decode((own / "mask.png").read_bytes())[..., 0]
        clean = png.decode((tmp_path / doc["source"]["uri"]).read_bytes())
        assert doc["event_frame_index"] == r.frame and V.check_pairing(clean, image, mask).ok
    before = run.stages["generate"].finished_at
    assert B.build(spark, ["v"], Still, config, tmp_path).stages["generate"].finished_at == before
    assert B.build(spark, ["v"], Still, config, tmp_path, force=True).stages["generate"].finished_at != before
    with pytest.raises(RuntimeError, match="failures"):
        B.build(spark, ["broken"], Still, config, tmp_path / "y")
    with pytest.raises(ValueError, match="no frames"):
        B.generate(spark, [], config, str(tmp_path))
