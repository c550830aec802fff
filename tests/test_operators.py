from __future__ import annotations

import random
import struct
import zlib

import numpy as np
import pytest

from lathework.operators import relational as R
from lathework.operators import sampling
from lathework.operators import sequential as S
from lathework.operators import vision as V
from lathework.plans import catalog, runner
from lathework.sources import readers, writers
from lathework.streaming import streams


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_islands_and_slots(spark):
    rng = random.Random(1)
    data = [(k, p) for k in range(4) for p in range(60) if rng.random() < 0.5]
    got = rows(R.islands(spark.createDataFrame(data, "k int, p int"), "k", "p", 2, 3))
    want = []
    for k in range(4):
        mask = np.zeros(60, bool)
        mask[[p for q, p in data if q == k]] = True
        want += [(k, a, b) for a, b in V.segments(mask, 3, 2)]
    assert got == sorted(want)
    times = sorted(rng.randint(0, 500) for _ in range(30))
    slots, last = [], -(10**9)
    for t in times:
        last = max(t, last + 20)
        slots.append(last)
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(times)], "k int, i int, t int")
    assert [r.slot for r in R.rate_slots(df, "k", ["i"], "t", 20).orderBy("i").collect()] == slots


def test_asof(spark):
    left = spark.createDataFrame([(1, 5, "a"), (1, 9, "b"), (1, 10, "c"), (2, 1, "d")], "k int, t int, n string")
    right = spark.createDataFrame([(1, 9, 7), (1, 9, 3), (1, 6, 8), (3, 4, 1)], "k int, t int, v int")
    assert rows(R.asof_forward(left, right, "k", "t", "v").select("n", "v")) == [("a", 8), ("b", 3), ("c", None), ("d", None)]


def test_upsert_and_violations(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(2, "z"), (3, "w")], "k int, v string")
    assert rows(R.upsert(a, b, ["k"])) == [(1, "x"), (2, "z"), (3, "w")]
    broken = R.violations(spark.createDataFrame([(1, 5), (2, None)], "k int, n int"), "k", {"small": R.F.col("n") < 3, "set": R.F.col("n").isNotNull()})
    assert rows(broken) == [(1, "small"), (2, "set"), (2, "small")]


def test_violations_make_each_row_once(spark):
    df = spark.range(3).select("id", R.F.struct(R.F.sha2(R.F.col("id").cast("string"), 256).alias("sha"), R.F.col("id").alias("n")).alias("s"))
    rules = {f"r{k}": R.F.col("s.sha").startswith(f"{k:x}") | (R.F.col("s.n") != k % 4) for k in range(130)}
    got = R.violations(df, "id", rules)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1
    sha = [__import__("hashlib").sha256(str(i).encode()).hexdigest() for i in range(3)]
    assert rows(got) == sorted((i, f"r{k}") for i in range(3) for k in range(130) if k % 4 == i and not sha[i].startswith(f"{k:x}"))


def test_histogram(spark):
    df = spark.createDataFrame([(x,) for x in (700, 800, 1500, 3000, 5)], "ms int")
    got = R.bucket_histogram(df, "ms", spark.createDataFrame([(0, 10, 1.0), (600, 1500, 2.0), (9000, 9999, 1.0)], "lo int, hi int, weight double"))
    assert [(r.lo, r.n, r.actual, r.target) for r in got.orderBy("lo").collect()] == [(0, 1, 0.2, 0.25), (600, 3, 0.6, 0.5), (9000, 0, 0.0, 0.25)]


def test_split():
    clusters = [(f"c{i}", n, {"platform": p}) for i, (n, p) in enumerate([(5, "north"), (1, "south"), (4, "north"), (2, "south")])]
    config = S.SplitConfig({"train": 0.5, "val": 0.3, "test": 0.2}, 11)
    first, again = S.allocate(clusters, config), S.allocate(clusters, config)
    assert first == again and set(first[0]) == {"c0", "c1", "c2", "c3"}
    assert S.allocate([(f"c{i}", 1, {"platform": "north"}) for i in range(5)], S.SplitConfig(config.ratios, 11, {"platform": 0.4}))[1]
    for bad in ({"train": 0.5}, {"train": 0.5, "dev": 0.5}, {}):
        with pytest.raises(ValueError):
            S.SplitConfig(bad)


def test_near_and_tracks(spark):
    assert S.greedy_near([("b", 3), ("a", 0), ("c", 255)], 2) == [("a", "a"), ("b", "a"), ("c", "c")]
    boxes = np.array([[0, 0, 1, 1], [0.1, 0, 1.1, 1], [5, 5, 6, 6], [0.2, 0, 1.2, 1]], float)
    assert S.track([0, 1, 1, 2], boxes, 0.5) == [0, 0, 1, 0]
    pairs = rows(R.hamming_pairs(spark.createDataFrame([(1, 0), (2, 7), (3, -1), (4, -2)], "id int, h long"), "id", "h", 3))
    assert pairs == [(1, 2, 3), (3, 4, 1)]


def test_near_clusters_settle_in_few_rounds(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(S, "cut", lambda df, cut=S.cut: cuts.append(df) or cut(df))
    chain = [(f"i{k:03d}", (1 << k) - 1) for k in range(40)]
    df = spark.createDataFrame(chain, "id string, hash long").repartition(3)
    assert rows(S.near_clusters(df, 1)) == S.greedy_near(chain, 1) and len(cuts) <= 3
    rng = random.Random(5)
    dense = [(f"i{k:03d}", sum(1 << b for b in range(12) if rng.random() < 0.5)) for k in range(400)]
    for at_once, most in ((3, 1), (64, 3)):
        monkeypatch.setattr(S, "AT_ONCE", at_once)
        assert rows(S.near_clusters(spark.createDataFrame(dense, "id string, hash long"), most)) == S.greedy_near(dense, most)


def plain_tracks(frames, boxes, least):
    last, out = [], [-1] * len(frames)
    for now in sorted(set(frames)):
        own = [i for i, f in enumerate(frames) if f == now]
        for t, prior in enumerate(last):
            free = [(S.box_iou(boxes[i], boxes[prior]), i) for i in own if out[i] < 0]
            if free and max(free)[0] >= least:
                out[max(free)[1]], last[t] = t, max(free)[1]
        for i in own:
            if out[i] < 0:
                out[i] = len(last)
                last.append(i)
    return out


def test_tracks_hold_a_frame_at_a_time(spark, monkeypatch):
    rng = np.random.default_rng(7)
    low = rng.integers(0, 6, (600, 2)) / 4
    boxes = np.hstack([low, low + rng.integers(0, 5, (600, 2)) / 4])
    frames = np.sort(rng.integers(0, 90, 600)).tolist()
    for least in (0.0, 0.3, 0.5):
        for pairs in (1, 20, 1 << 18):
            monkeypatch.setattr(S, "PAIRS", pairs)
            assert S.track(frames, boxes, least) == plain_tracks(frames, boxes, least)
    want = plain_tracks(frames, boxes, 0.3)
    data = [(v, f, k, *map(float, b)) for v in ("a", "b", None) for k, (f, b) in enumerate(zip(frames, boxes, strict=True))]
    df = spark.createDataFrame(data, "video string, frame long, box long, x0 double, y0 double, x1 double, y1 double").repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = S.tracks(df, 0.3)
        assert "FlatMapGroups" not in got._jdf.queryExecution().optimizedPlan().toString()  # no video is held whole
        assert {(r.video, r.box): r.track for r in got.collect()} == {(v, k): t for v in ("a", "b", None) for k, t in enumerate(want)}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_sampling(spark):
    got = {r.sample_index: tuple(r) for r in sampling.draw_samples(spark, 20, 5, ["a", "b"]).collect()}
    for i in range(20):
        want = sampling.draw(i, 5, ["a", "b"], sampling.Plan())
        assert got[i][:7] == tuple(want[n] for n in sampling.NAMES[:7]) and got[i][-1] == want["y"] and got[i][14] == list(want["fill"])
    none = sampling.draw_samples(spark, 3, 5, ["a"], fits=lambda row: False).collect()
    assert {r.attempt for r in none} == {None} and all(r.duration_ms for r in none)
    x0, y0, x1, y1 = sampling.random_crop(random.Random(1), 500, 300, 1, 1)
    assert (x1 - x0, y1 - y0) == (300, 300) and 0 <= x0 <= 200 and y0 == 0
    with pytest.raises(ValueError):
        sampling.draw_samples(spark, 1, 1, [])


def test_vision():
    image = np.full((60, 100, 3), 40, np.uint8)
    rendered = image.copy()
    rendered[30:50, 20:70] = 200
    mask = np.zeros((60, 100), np.uint8)
    mask[30:50, 20:70] = 1
    assert V.check_pairing(image, rendered, mask).ok and V.check_pairing(image, rendered, mask).changed_box == (20, 30, 70, 50)
    assert not V.check_pairing(image, rendered, mask * 0).ok and not V.check_pairing(image, rendered[:-1], mask).same_size
    assert V.dilate(mask, 2).sum() == 24 * 54 and V.alpha_box(mask) == (20, 30, 70, 50)
    assert V.difference_hash(image) == "0" * 16 and V.difference_hash(np.tile(np.arange(90, dtype=np.uint8), (16, 1))) == "f" * 16
    stripes = np.zeros((40, 80), np.uint8)
    stripes[20:30, 10:60:2] = 255
    (x0, y0, x1, y1, _), *rest = V.text_regions(stripes)
    assert not rest and x0 <= 10 and x1 >= 58 and y0 <= 20 and y1 >= 29
    assert V.mask_iou(np.ones((2, 2)), np.ones((2, 4))) == 0.5


def test_readers(spark, tmp_path):
    lines = spark.createDataFrame([("# no",), ("",), ("　 x ",), ("y",)], "value string")
    assert rows(readers.corpus(lines)) == [("x",), ("y",)]
    log = spark.createDataFrame([("[x] n:   2 pts:  512 pts_time:0.5 pos: 1",), ("n: 3 pts: -5 pts_time:-1",), ("else",)], "value string")
    assert rows(readers.timeline(readers.frame_log(log), 1, 1024)) == [(2, 512, 0.5, 500)]
    chunk = lambda kind, data=b"": struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    png = b"\x89PNG\r\n\x1a\n" + chunk(b"IDAT", b"zz") + chunk(b"IEND")
    assert list(readers.split_pngs(png + png)) == [png, png]
    with pytest.raises(ValueError):
        list(readers.split_pngs(png[:-13]))
    writers.write_table(lines.limit(0), f"{tmp_path}/t", lines.schema)
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["value"]


def test_stream_and_runner(spark, tmp_path):
    data = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    data.write.parquet(f"{tmp_path}/in")
    for turn in range(2):
        stream = spark.readStream.schema(data.schema).parquet(f"{tmp_path}/in")
        streams.collect_once(stream, ["k"], f"{tmp_path}/ledger", f"{tmp_path}/check{turn}").awaitTermination()
    assert rows(spark.read.parquet(f"{tmp_path}/ledger")) == [(1, "a"), (2, "b")]
    calls = []
    work = [("one", lambda: calls.append(1) or ["x"], "h"), ("two", lambda: 1 / (len(calls) - 1) and [], "h")]
    with pytest.raises(ZeroDivisionError):
        runner.execute(tmp_path, "r", work)
    assert runner.load_run(tmp_path).stages["two"].status == "failed"
    calls.append(1)
    assert runner.execute(tmp_path, "r", work).stages["two"].status == "done" and calls == [1, 1]


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_samples_are_drawn_from_all_lines(spark, tmp_path):
    lines = [f"line {k}\n" if k % 9 == 0 else f"line {k}" for k in range(1500)]
    items = [(k, t) for k, t in enumerate(lines)] + [(7, None)]
    spark.createDataFrame(items[::-1], "item_id long, text string").repartition(5).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.sample_index: tuple(r) for r in catalog.queries()["seeded_samples"](spark, str(tmp_path)).collect()}
    assert len(got) == 5000
    for i in range(0, 5000, 7):
        want = sampling.draw(i, 42, lines, sampling.Plan())
        assert got[i][:7] == tuple(want[n] for n in sampling.NAMES[:7]) and got[i][-1] == want["y"]
