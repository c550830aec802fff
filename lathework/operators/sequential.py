"""Operators whose result depends on an order: greedy splits, greedy near clusters, box tracks.

Splits and tracks run on one row per cluster or box of a group, inside a grouped function; the scalable alternative to
the greedy split stands in ``relational`` under another name, as its results differ. Near clusters settle in rounds.
"""

from __future__ import annotations

import random
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from lathework.operators.relational import hamming_pairs
from lathework.shipping import ship
from lathework.tables import cut

SPLITS = ("train", "val", "test")
#: Hashes that take the greedy pass at once, and sides of a tile of distances.
AT_ONCE, TILE = 1 << 15, 256
#: Overlaps that are held at once, and tasks that videos are dealt to at least.
PAIRS, VIDEO_TASKS = 1 << 18, 64


@dataclass(frozen=True)
class SplitConfig:
    ratios: dict[str, float] = field(default_factory=lambda: {"train": 0.8, "val": 0.1, "test": 0.1})
    seed: int = 42
    limits: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        if not self.ratios or set(self.ratios) - set(SPLITS):
            raise ValueError(f"ratios need names among {SPLITS}")
        if min(self.ratios.values()) <= 0 or abs(sum(self.ratios.values()) - 1) > 1e-6:
            raise ValueError("ratios must be positive and add up to 1")
        if any(not 0 < x <= 1 for x in self.limits.values()):
            raise ValueError("limits lie in (0, 1]")


class Shelves:
    """What each split holds: items, and items of each group, an array over the splits for each."""

    def __init__(self, config: SplitConfig, total: int):
        self.names, self.limits, self.total = list(config.ratios), config.limits, max(total, 1)
        self.wanted = np.array(list(config.ratios.values()))
        self.items = np.zeros(len(self.names), np.int64)
        self.groups: dict[tuple[str, str], np.ndarray] = defaultdict(lambda: np.zeros(len(self.names), np.int64))

    def allowed(self, size: int, keys: dict[str, str]) -> np.ndarray:
        """Splits that are empty or in which each limited group keeps its share with ``size`` more of it."""
        ok = np.ones(len(self.names), bool)
        for dimension, most in self.limits.items():
            if dimension in keys:
                ok &= (self.groups[dimension, keys[dimension]] + size) / (self.items + size) <= most
        return ok | (self.items == 0)

    def put(self, size: int, keys: dict[str, str]) -> tuple[str, bool]:
        """Where a cluster goes: of the allowed splits, or of all if none is, the one that lacks most; the first of equals."""
        lack = self.wanted - self.items / self.total
        ok = self.allowed(size, keys)
        to = int(np.where(ok, lack, -np.inf).argmax() if ok.any() else lack.argmax())
        self.items[to] += size
        for group in keys.items():
            self.groups[group][to] += size
        return self.names[to], bool(ok.any())

    def crowded(self) -> list[str]:
        """Groups above their limits, a line for each split and group."""
        shares = {g: n / np.maximum(self.items, 1) for g, n in self.groups.items()}
        return [f"{name}: {100 * share[i]:.2f} % are of {d} {k}" for (d, k), share in shares.items() for i, name in enumerate(self.names) if share[i] > self.limits.get(d, 1.0)]


def allocate(clusters: list[tuple[str, int, dict[str, str]]], config: SplitConfig) -> tuple[dict[str, str], list[str]]:
    """Split of each cluster (id, size, keys by dimension), in an order drawn by the seed, and what could not be kept."""
    drawn = list(clusters)
    random.Random(config.seed).shuffle(drawn)
    shelves = Shelves(config, sum(size for _, size, _ in clusters))
    placed: dict[str, str] = {}
    forced: list[str] = []
    for name, size, given in drawn:
        placed[name], fits = shelves.put(size, {d: k for d, k in given.items() if k} | {"cluster": name})
        if not fits:
            forced.append(f"no split has room for {name} within the limits; it went to {placed[name]}")
    return placed, forced + shelves.crowded()


def greedy_split(clusters: DataFrame, config: SplitConfig) -> DataFrame:
    """``cluster_id, split`` for clusters (cluster_id, n_items, platform, creator, video), a row per cluster."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("cluster_id")
        rows = [(r.cluster_id, int(r.n_items), {d: getattr(r, d) for d in ("platform", "creator", "video")}) for r in pdf.itertuples()]
        found, _ = allocate(rows, config)
        return pd.DataFrame({"cluster_id": list(found), "split": list(found.values())})

    ship(clusters.sparkSession)
    return clusters.withColumn("_all", F.lit(1)).groupBy("_all").applyInPandas(run, "cluster_id string, split string")


def greedy_near(items: list[tuple[str, int]], most: int) -> list[tuple[str, str]]:
    """Item and representative: each item, by id, joins the first representative within ``most`` bits, or founds one."""
    ids: list[str] = []
    hashes = np.zeros(len(items), np.uint64)
    out = []
    for name, value in sorted(items):
        x = np.uint64(value & (2**64 - 1))
        near = np.flatnonzero(np.bitwise_count(hashes[: len(ids)] ^ x) <= most)
        if len(near):
            out.append((name, ids[near[0]]))
        else:
            hashes[len(ids)] = x
            ids.append(name)
            out.append((name, name))
    return out


def first_near(hashes: np.ndarray, founders: np.ndarray, most: int) -> np.ndarray:
    """Place of the first founder within ``most`` bits of each hash, -1 without any; in tiles of bounded size."""
    out = np.full(len(hashes), -1, np.int64)
    for low in range(0, len(hashes), TILE):
        open_ = np.arange(low, min(low + TILE, len(hashes)))
        for at in range(0, len(founders), TILE):
            near = np.bitwise_count(hashes[open_, None] ^ founders[None, at : at + TILE]) <= most
            hit = near.any(axis=1)
            out[open_[hit]] = at + near[hit].argmax(axis=1)
            open_ = open_[~hit]
            if not len(open_):
                break
    return out


def settle(left: DataFrame, founders: list[tuple[object, int]], most: int) -> DataFrame:
    """Adds ``representative_id``, the first of the founders that is near, or null; the rows keep their order."""
    names, hashes = [name for name, _ in founders], np.array([value for _, value in founders], np.int64).view(np.uint64)
    kind = left.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("hash", T.LongType()), T.StructField("representative_id", kind)])

    def run(batches):
        for batch in batches:
            own = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            found = first_near(own, hashes, most)
            known = pa.array(names, batch.column(0).type)
            taken = known.take(pa.array(found, mask=found < 0))
            yield pa.RecordBatch.from_arrays([*batch.columns, taken], names=["id", "hash", "representative_id"])

    ship(left.sparkSession)
    return left.mapInArrow(run, schema)


def linked_clusters(by_hash: DataFrame, most: int) -> DataFrame:
    """``hash, representative_id`` of distinct hashes, by links of near ones.

    In each round all items whose smaller near ones are settled settle too, so chains of ids in order cost a round each,
    others few.
    """
    links = cut(hamming_pairs(by_hash, "id", "hash", most).select(F.col("a").alias("small"), F.col("b").alias("large")))
    state = cut(by_hash.select("id", F.lit(None).cast("boolean").alias("founds")))
    while not state.where("founds is null").isEmpty():
        below = links.join(state.select(F.col("id").alias("small"), "founds"), "small").groupBy(F.col("large").alias("id"))
        seen = below.agg(F.bool_or(F.coalesce("founds", F.lit(False))).alias("taken"), F.bool_or(F.col("founds").isNull()).alias("waits"))
        settled = F.when(F.coalesce("taken", F.lit(False)), False).when(~F.coalesce("waits", F.lit(False)), True)
        state = cut(state.join(seen, "id", "left").select("id", F.coalesce("founds", settled).alias("founds")))
    founders = state.where("founds").select(F.col("id").alias("small"))
    joined = links.join(founders, "small").groupBy(F.col("large").alias("id")).agg(F.min("small").alias("first"))
    own = state.join(joined, "id", "left").select("id", F.when(F.col("founds"), F.col("id")).otherwise(F.col("first")).alias("representative_id"))
    return by_hash.join(own, "id").select("hash", "representative_id")


def near_clusters(items: DataFrame, most: int = 2) -> DataFrame:
    """Greedy clusters of (id, hash long): ``id, representative_id``; rows without a hash are left out.

    What the greedy pass over the ids gives. The distinct hashes are sorted by id once; the first ``AT_ONCE`` of those
    left take the pass, then all others are held against their founders, each batch on its own, and what is near one is
    settled. So the pairs of a dense table are never listed. Where less than half is settled in a round, few are near
    each other, and links of near ones settle the rest.
    """
    known = items.where("hash is not null").select("id", "hash")
    left = cut(known.groupBy("hash").agg(F.min("id").alias("id")).where("id is not null").select("id", "hash").orderBy("id"))
    own, n = [], left.count()
    while n:
        begin = [tuple(r) for r in left.limit(AT_ONCE).collect()]  # the smallest ids, as the sorted partitions are read in turn
        value = dict(begin)
        found = [(name, value[name]) for name, first in greedy_near(begin, most) if name == first]
        scan = cut(settle(left, found, most))
        own.append(scan.where("representative_id is not null").select("hash", "representative_id"))
        left, before = scan.where("representative_id is null").select("id", "hash"), n
        n = left.count()
        if n > max(AT_ONCE, before // 2):
            own.append(linked_clusters(left, most))
            break
    if not own:
        return known.select("id", F.col("id").alias("representative_id"))
    return known.join(reduce(DataFrame.unionAll, own), "hash").select("id", "representative_id")


def box_iou(a: np.ndarray, b: np.ndarray) -> float:
    wide, high = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(wide, 0.0) * max(high, 0.0)
    union = sum((x[2] - x[0]) * (x[3] - x[1]) for x in (a, b)) - both
    return both / union if union > 0 else 0.0


class Tracker:
    """Tracks of a video, fed frame by frame in order; of what is past it keeps the last box of each track only."""

    def __init__(self, least: float):
        self.least, self.n, self.last = least, 0, np.zeros((64, 4))

    def frame(self, boxes: np.ndarray) -> np.ndarray:
        """Track of each box of the next frame."""
        out = np.full(len(boxes), -1, np.int64)
        step = max(PAIRS // max(len(boxes), 1), 1)
        for low in range(0, self.n, step):
            free = np.flatnonzero(out < 0)
            if not len(free):
                break
            self.choose(low, min(low + step, self.n), boxes, free, out)
        new = np.flatnonzero(out < 0)
        out[new] = self.n + np.arange(len(new))
        self.n += len(new)
        if self.n > len(self.last):
            self.last = np.concatenate([self.last, np.zeros((self.n, 4))])
        self.last[out] = boxes
        return out

    def choose(self, low: int, high: int, boxes: np.ndarray, free: np.ndarray, out: np.ndarray) -> None:
        """Lets some tracks choose among the free boxes, the older first."""
        share = box_ious(boxes[free], self.last[low:high])
        at, of = np.nonzero(share >= self.least)
        chosen, taken = set(), set()
        for t, _, i in sorted(zip(at.tolist(), share[at, of].tolist(), free[of].tolist(), strict=True), key=lambda x: (x[0], -x[1], -x[2])):
            if t not in chosen and i not in taken:
                chosen.add(t)
                taken.add(i)
                out[i] = low + t


def box_ious(boxes: np.ndarray, tracks: np.ndarray) -> np.ndarray:
    """``box_iou`` of each track's box (rows) and each box (columns)."""
    a, b = boxes[None], tracks[:, None]
    wide, high = (np.minimum(a[..., k + 2], b[..., k + 2]) - np.maximum(a[..., k], b[..., k]) for k in (0, 1))
    both = np.maximum(wide, 0.0) * np.maximum(high, 0.0)
    union = (a[..., 2] - a[..., 0]) * (a[..., 3] - a[..., 1]) + (b[..., 2] - b[..., 0]) * (b[..., 3] - b[..., 1]) - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def track(frames: list[int], boxes: np.ndarray, least: float) -> list[int]:
    """Track of each box, boxes in frame order: older tracks choose first, the best overlap of their last box wins, the
    later one of equals; a box left over begins a track."""
    order = np.argsort(frames, kind="stable")
    starts = np.flatnonzero(np.diff(np.asarray(frames)[order])) + 1
    tracker, out = Tracker(least), np.full(len(frames), -1, np.int64)
    for own in np.split(order, starts) if len(order) else []:
        out[own] = tracker.frame(boxes[own])
    return out.tolist()


def tracked(batches, least: float):
    """Adds tracks to batches (video, frame, box, x0, y0, x1, y1) in order of the first three. A frame can go on in the next
    batch; no more than a batch and a frame is held. Boxes without a frame get -1."""
    names = ["video", "frame", "box", "x0", "y0", "x1", "y1"]
    tracker, video, held = Tracker(least), None, []

    def flush(rows: list[pa.RecordBatch]):
        nonlocal tracker, video
        if rows:
            own = pa.Table.from_batches(rows).combine_chunks()
            if (now := own["video"][0].as_py()) != video:
                tracker, video = Tracker(least), now
            sides = np.stack([own[c].to_numpy().astype(float) for c in names[3:]], axis=1)
            found = np.full(len(own), -1, np.int64) if own["frame"][0].as_py() is None else tracker.frame(sides)
            yield from own.append_column("track", pa.array(found)).to_batches()

    for batch in batches:
        if not len(batch):
            continue
        part = [pc.fill_null(pc.not_equal(c[1:], c[:-1]), False).to_numpy(zero_copy_only=False) | (c[1:].is_null().to_numpy(zero_copy_only=False) != c[:-1].is_null().to_numpy(zero_copy_only=False)) for c in (batch.column(0), batch.column(1))]
        starts = [0, *(np.flatnonzero(part[0] | part[1]) + 1).tolist(), len(batch)]
        done = []
        for low, high in zip(starts, starts[1:]):
            rows = batch.slice(low, high - low)
            if held and (held[0]["video"][0].as_py(), held[0]["frame"][0].as_py()) != (rows["video"][0].as_py(), rows["frame"][0].as_py()):
                done += flush(held)
                held = []
            held.append(rows)
        if done:
            yield from pa.Table.from_batches(done).combine_chunks().to_batches()
    yield from flush(held)


def tracks(boxes: DataFrame, least: float = 0.5) -> DataFrame:
    """Adds ``track`` to boxes (video, frame, box, x0, y0, x1, y1), each video on its own, in a task of its own as far as
    hashes allow: the number of tasks is given, so small videos aren't put together."""

    def run(batches):
        return tracked(batches, least)

    spark = boxes.sparkSession
    ship(spark)
    kinds = {"video": "string", "frame": "long", "box": "long"}
    own = boxes.select(*(F.col(c).cast(kinds.get(c, "double")).alias(c) for c in ("video", "frame", "box", "x0", "y0", "x1", "y1")))
    n = max(VIDEO_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "video string, frame long, box long, x0 double, y0 double, x1 double, y1 double, track long"
    return own.repartition(n, "video").sortWithinPartitions("video", "frame", "box").mapInArrow(run, schema)


def persistent(tracked: DataFrame, frames: int, least: float, spread: float) -> DataFrame:
    """Tracks seen in a share of the frames and steady: persistence, mean box, population deviation of the centre."""
    x, y = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    means = [F.avg(c).alias(c) for c in ("x0", "y0", "x1", "y1")]
    seen = tracked.groupBy("video", "track").agg((F.countDistinct("frame") / frames).alias("persistence"), ((F.stddev_pop(x) + F.stddev_pop(y)) / 2).alias("position_std"), *means)
    return seen.where((F.col("persistence") >= least) & (F.col("position_std") <= spread))


def majority(df: DataFrame, key: list[str], value: str, order: str) -> DataFrame:
    """Most frequent value of a key; of equals the one seen first."""
    n = df.groupBy(*key, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.groupBy(*key).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def content_switches(tracked: DataFrame, least: float) -> DataFrame:
    """``video, track, switched``: whether two observations in a row of a track (frame, mask) differ by more than allowed.

    A mask is a row of 0 and 1 over a common grid of its box; two masks without any 1 are alike.
    """
    after = F.lead("mask").over(W.partitionBy("video", "track").orderBy("frame"))
    pairs = F.zip_with("mask", "_next", lambda a, b: F.struct((F.coalesce(a, F.lit(0)) * F.coalesce(b, F.lit(0))).alias("i"), F.greatest(F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))).alias("u")))
    total = lambda n: F.aggregate(F.transform("_pairs", lambda p: p[n]), F.lit(0), lambda x, y: x + y)
    rows = tracked.withColumn("_next", after).withColumn("_pairs", pairs)
    share = F.when(total("u") == 0, 1.0).otherwise(total("i") / total("u"))
    return rows.groupBy("video", "track").agg(F.coalesce(F.bool_or(share < least), F.lit(False)).alias("switched"))


def video_verdicts(persistent_boxes: DataFrame, videos: DataFrame) -> DataFrame:
    """A row for each video: steady boxes by role, and whether it has subtitles of its own; videos without boxes too."""
    count = {role: F.count_if(F.col("role") == role) for role in ("subtitle", "watermark", "scene_text")}
    seen = persistent_boxes.groupBy("video").agg(*(n.alias(f"{role}_boxes") for role, n in count.items()))
    out = videos.select("video").distinct().join(seen, "video", "left").na.fill(0, [f"{role}_boxes" for role in count])
    return out.withColumn("subtitle_present", F.col("subtitle_boxes") > 0)


def last_by_id(events: DataFrame, key: str, order: str) -> DataFrame:
    """One row for each id, the last in order; ``first`` tells where the id came first."""
    rest = [c for c in events.columns if c != key]
    found = events.groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_last"), F.min(order).alias("first"))
    return found.select(key, "_last.*", "first")
