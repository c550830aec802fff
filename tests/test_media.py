from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lathework.__main__ import main
from lathework.functions import media
from lathework.operators import collection, reports
from lathework.plans import export


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_probe(spark):
    doc = {"format": {"format_name": "mp4", "duration": "7.25"}, "streams": [{"codec_type": "audio"}, {"codec_type": "video", "width": 96, "height": 54, "avg_frame_rate": "24/1", "r_frame_rate": "24/1", "time_base": "1/90000", "nb_frames": "N/A"}]}
    p = spark.createDataFrame([(json.dumps(doc),), ('{"streams": []}',)], "j string").select(media.probe(F.col("j")).alias("p")).collect()
    assert p[1].p is None
    assert (p[0].p.width, p[0].p.duration_seconds, tuple(p[0].p.time_base), p[0].p.is_vfr, p[0].p.nb_frames) == (96, 7.25, (1, 90000), False, None)


def test_scenes(spark):
    frames = spark.createDataFrame([("v", i, i / 10) for i in range(15)], "video string, n long, t double")
    cuts = spark.createDataFrame([("v", 0.45), ("v", 1.0)], "video string, t double")
    ends = spark.createDataFrame([("v", 1.5)], "video string, t double")
    s = media.scenes(cuts, frames, ends)
    assert rows(s) == [("v", 0, 0, 5), ("v", 1, 5, 10), ("v", 2, 10, 15)]
    assert [r.p for r in s.select(media.representative_frames(F.col("start_frame"), F.col("end_frame"), 1).alias("p")).collect()] == [[2], [7], [12]]
    assert s.select(media.representative_frames(F.col("start_frame"), F.col("end_frame"), 3).alias("p")).first().p == [0, 2, 4]


def test_collection(spark):
    items = spark.createDataFrame([("s", str(i), f"http://x/{i}") for i in range(4)], "source_id string, item_id string, url string")
    ledger = items.where("item_id = '0'")
    todo = collection.pending(items, ledger)

    def get(url):
        if url.endswith("2"):
            raise OSError("gone")
        return b"abc"

    got = collection.fetch(todo, get, [0.0])
    assert {(r.item_id, r.size_bytes, r.error) for r in got.collect()} == {("1", 3, None), ("2", None, "OSError: gone"), ("3", 3, None)}
    assert rows(collection.report(items, ledger, got)) == [("s", 4, 1, 2, 1)]
    assert collection.pending(items, ledger, items.select("source_id").distinct()).count() == 0
    assert collection.delays(1.0, 3) == [1.0, 2.0, 4.0] and collection.remove(items, ledger).count() == 3


def test_reports(spark):
    df = spark.createDataFrame([("c", True, 0.1, 0.5, 0.7, 700)] * 3, "config_sha256 string, pairing_ok boolean, font_size double, x double, y double, ms int")
    assert reports.samples(df).first().pairing_ok == 3 and reports.samples(df.limit(0)).first().font_size_mean == 0.0
    targets = spark.createDataFrame([(0, 500, 1.0), (600, 900, 1.0)], "lo int, hi int, weight double")
    b = reports.durations(df, "ms", targets, 0.15)
    assert reports.verdict(b, 3, 5) == "3 samples are fewer than 5; bucket 0-500 ms deviates by -0.500; bucket 600-900 ms deviates by +0.500"


def test_export(spark):
    base = {"num": 2, "den": 90000}
    video = {"width": 96, "height": 54, "time_base": base, "avg_frame_rate": {"avg_num": 50, "avg_den": 2}, "r_frame_rate": {"r_num": 25, "r_den": 1}, "is_vfr": True}
    frame = {"scene_index": 4, "native_frame_index": 8, "pts": 14400, "pts_time_seconds": 0.32, "timestamp_ms": 320, "crop_xywh": [3, 5, 48], "target_size": [192, 108], "crop_mode": "random", "uri": "f/8.png", "image_sha256": "dd"}
    doc = {"video_sha256": "cc", "probe": {"video": video}, "frames": [frame], "scenes": [{"index": 4, "start_frame": 6}], "failures": [{"stage": "cut"}]}
    manifest = spark.read.json(spark.sparkContext.parallelize([json.dumps(doc)]))
    out = export.flat_manifest(manifest)
    f = out["frames"].first()
    assert (f.crop_y, f.crop_h, f.target_width, f.time_base_den, f.avg_num, f.r_num, f.source_width) == (5, 0, 192, 90000, 50, 25, 96)
    assert out["scenes"].first().start_frame == 6 and out["failures"].first().stage == "cut"
    assert {r.id for r in export.dedup_items(manifest).collect()} == {"video:cc", "frame:cc:f/8.png"}
    r = export.sources_and_transforms(manifest, "p").first()
    assert (r.uri, r.source.platform, r.source.timestamp_ms, r.source.time_base.den, r.source.frame_rate.is_vfr, r.transform.target_size) == ("f/8.png", "p", 320, 90000, True, [192, 108])
    pairs = spark.createDataFrame([([1, 2], ["a", "b"])], "x array<int>, y array<string>")
    assert [tuple(z) for z in pairs.select(export.strict_zip(F.col("x"), F.col("y")).alias("z")).first().z] == [(1, "a"), (2, "b")]
    with pytest.raises(Exception, match="differ in length"):
        pairs.select(export.strict_zip(F.col("x"), F.array(F.lit("a")))).collect()


def test_command_line(spark, tmp_path, capsys):
    assert main(["query", "--name", "none", "--tables", "x", "--out", "y"]) == 2 and "no query" in capsys.readouterr().err
    (tmp_path / "c.txt").write_text("# no\nwords\n")
    assert main(["generate", "--corpus", f"{tmp_path}/c.txt", "--n", "3", "--seed", "1", "--out", f"{tmp_path}/out"]) == 0
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    assert main(["status", "--folder", str(tmp_path)]) == 2
    with pytest.raises(SystemExit):
        main(["what"])
