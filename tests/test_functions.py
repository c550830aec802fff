from __future__ import annotations

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lathework.functions import geometry as G
from lathework.functions import ids, text
from lathework.functions import timebase as T


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ("ＡＢＣ１２３＠", "ABC123@"), ("你　好  吗", "你 好 吗"), (" 第一行 \r\n第二行\r", "第一行\n第二行"), ("今天ＡＢＣ一起吃饭　。\r\n  明天见  ", "今天ABC一起吃饭。\n明天见"),
        ("（ 甲 ） ， 乙", "（甲）， 乙"), ("  x \u001f", "x"), ("", ""), (None, None),
    ],
)
def test_normalize(spark, given, want):
    assert value(spark, text.normalize(F.lit(given).cast("string"))) == want


def test_normalize_rules(spark):
    assert value(spark, text.applied_rules(F.lit("Ａ \r"))) == ["fullwidth_ascii", "newlines", "strip_lines"]
    with pytest.raises(ValueError):
        text.rules_of("v9")


@pytest.mark.parametrize(("given", "want"), [("漢字かな", "Japanese"), ("한국 漢", "Korean"), ("漢字abc", "CJK"), ("abc 1", "Latin"), ("عربي", "Arabic"), ("12 !", "Other"), ("", "Other"), ("Ａª", "Other"), ("甲・乙", "Japanese")])
def test_script(spark, given, want):
    assert value(spark, text.detect_script(F.lit(given))) == want


def test_text_helpers(spark):
    assert value(spark, text.line_count(F.lit("a\n\nb\n"))) == 4
    assert value(spark, text.has_blank_line(F.lit("a\n 　\nb"))) is True
    assert value(spark, text.checkable_chars(F.lit("ab a​\n　é"))) == ["a", "b", "é"]


def test_ids(spark):
    fields = {"dataset_version": "v1", "video_sha256": None, "native_frame_index": 3, "pts": 4, "style_seed": 5, "crop_xywh": [0, 0, 6, 7], "event_id": "é\"x"}
    want = hashlib.sha256(json.dumps(fields, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
    crop = F.array(*map(F.lit, (0, 0, 6, 7)))
    own = ids.sample_id(F.lit("v1"), F.lit(None).cast("string"), F.lit(3), F.lit(4), crop, F.lit("é\"x"), F.lit(5))
    assert value(spark, own) == want
    assert value(spark, ids.hash_of_hex(F.lit("ffffffffffffffff"))) == -1
    assert value(spark, ids.hamming(F.lit(-1).cast("long"), F.lit(0).cast("long"))) == 64


def test_time(spark):
    n = lambda x: F.lit(x).cast("long")
    assert value(spark, T.ticks_to_ms(n(38148), n(1), n(3000))) == 12716
    assert [value(spark, T.ticks_to_ms(n(x), n(1), n(2000))) for x in (1, 3, 5)] == [0, 2, 2]
    assert value(spark, T.ms_to_pts(n(1), n(1), n(500))) == 0
    assert [tuple(value(spark, T.parse_fraction(F.lit(x)))) for x in ("30000/1001", "0/0", "N/A", "5/-1", "25")] == [(30000, 1001), (0, 1), (0, 1), (0, 1), (25, 1)]
    assert value(spark, T.aspect_label(n(1920), n(1080))) == "16:9"
    assert [value(spark, T.fade_factor(n(t), n(0), n(1000), n(100), n(200))) for t in (0, 50, 500, 900, 1000)] == [0.0, 0.5, 1.0, 0.5, 0.0]
    assert value(spark, T.even_picks(n(10), 4)) == [0, 3, 6, 9] and value(spark, T.even_picks(n(3), 5)) == [0, 1, 2] and value(spark, T.even_picks(n(0), 3)) == []
    assert value(spark, T.representative_time(n(100), n(7), 1, n(0))) == 103
    t = value(spark, T.event_timing(n(1000), n(200), n(10), F.lit(25.0), n(1), n(1000)))
    assert (t.start_time_ms, t.end_time_ms, t.duration_frames, t.start_frame, t.end_frame) == (0, 1000, 25, 0, 25)


def test_geometry(spark):
    b = lambda *x: tuple(F.lit(float(v)) for v in x)
    assert value(spark, G.iou(b(0, 0, 2, 1), b(1, 0, 3, 1))) == pytest.approx(1 / 3)
    assert value(spark, G.iou(b(0, 0, 0, 0), b(0, 0, 0, 0))) == 0.0
    assert value(spark, G.intersects(b(0, 0, 1, 1), b(1, 0, 2, 1))) is False
    assert [value(spark, G.geometric_role(b(*x))) for x in ((0.2, 0.8, 0.8, 0.9), (0.02, 0.02, 0.1, 0.1), (0.3, 0.3, 0.6, 0.4))] == ["subtitle", "watermark", "scene_text"]
    c = value(spark, G.center_crop(F.lit(640), F.lit(360), F.lit(1), F.lit(1)))
    assert tuple(c) == (140, 0, 500, 360, 360, 360)
    assert [value(spark, x) for x in G.widened(b(0.005, 0.5, 0.6, 0.995), 0.01)] == pytest.approx([0, 0.49, 0.61, 1])


def test_rules_over_arrays_are_the_expressions(spark):
    import random

    rng = random.Random(4)
    alphabet = "ab \t\r\n\u3000\u2003\x0b\x00（，】「Ａ！ｚé漢😀"
    texts = [None, "", " ", "\r\n", *("".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(400))]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(2)
    names, now, want = text.rules_of(), df.select("id", "t", F.col("t").alias("t0")), []
    for i, name in enumerate(names):  # staged, so that no text is made twice
        now = now.withColumn(f"t{i + 1}", text.RULES[name](F.col(f"t{i}"))).localCheckpoint()
        want.append(F.when(~F.col(f"t{i}").eqNullSafe(F.col(f"t{i + 1}")), name))
    for r in now.select("t", f"t{len(names)}", F.array_compact(F.array(*want)).alias("hits"), text.normalize(F.col("t")).alias("n"), text.applied_rules(F.col("t")).alias("h")).collect():
        assert (r.n, r.h) == (r[1], r.hits), r
    plan = df.select(text.applied_rules(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") <= len(names)  # each rule is applied once, not once for each that follows
