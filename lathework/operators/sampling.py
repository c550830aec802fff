"""Seeded sampling: draws of Python's generator, one generator for each index, so that rows don't depend on partitions."""

from __future__ import annotations

import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions.timebase import fade_factor, representative_time
from lathework.shipping import ship

#: Fixed value: distance of the seeds of neighbouring samples.
SEED_STEP = 7919
Range = tuple[float, float]
Weighted = list[tuple[object, float]]
ALIGN = ("left", "center", "right")
WHITE, BLACK = (255, 255, 255, 255), (0, 0, 0, 255)


def pick(rng: random.Random, options: Weighted):
    """Weighted choice: one uniform draw against the running sum."""
    at, acc = rng.uniform(0, sum(w for _, w in options)), 0.0
    for name, w in options:
        acc += w
        if at <= acc:
            return name
    return options[-1][0]


@dataclass(frozen=True)
class Style:
    """Distribution of a text's look; a font may bring a size range of its own."""

    fonts: Weighted = field(default_factory=lambda: [(("sans", (0.025, 0.055)), 1.0)])
    size: Range = (0.025, 0.05)
    letter_spacing: Range = (0.0, 2.0)
    line_spacing: Range = (0.0, 8.0)
    stroke: Range = (0.0, 0.006)
    opacity: Range = (0.85, 1.0)
    align: Weighted = field(default_factory=lambda: [("center", 0.85), ("left", 0.075), ("right", 0.075)])
    fills: Weighted = field(default_factory=lambda: [(WHITE, 1.0), ((255, 240, 200, 255), 0.25), (BLACK, 0.05)])
    strokes: Weighted = field(default_factory=lambda: [(BLACK, 1.0)])
    shadow: float = 0.3
    shadow_offset: tuple[float, float] = (3.0, 3.0)
    shadow_blur: Range = (0.0, 2.0)
    shadows: Weighted = field(default_factory=lambda: [(BLACK, 1.0)])
    bar: float = 0.3
    bars: Weighted = field(default_factory=lambda: [((0, 0, 0, 180), 1.0)])
    bar_shape: tuple[Range, Range, Range] = ((0.005, 0.015), (0.004, 0.01), (0.005, 0.015))
    rotation: float = 0.15
    degrees: float = 8.0


@dataclass(frozen=True)
class Plan:
    """What is drawn for an event, in this order: duration, lines of text, fades; then style and position an attempt."""

    durations: Weighted = field(default_factory=lambda: [((130, 270), 1.0), ((300, 500), 1.5), ((530, 1000), 2.0), ((1030, 2000), 1.5), ((2030, 3000), 0.8), ((3030, 4000), 0.4)])
    single_line: float = 0.75
    fade: float = 0.3
    fades: tuple[Range, Range] = ((0.0, 0.2), (0.0, 0.2))
    style: Style = field(default_factory=Style)
    columns: Weighted = field(default_factory=lambda: [((0.45, 0.55), 0.7), ((0.15, 0.85), 0.3)])
    rows: Range = (0.65, 0.85)
    attempts: int = 20
    frames: int = 1  #: frames of an event, 1 to 3

    def __post_init__(self):
        """Ranges go from the smaller to the larger number, and options are known and have a positive weight."""
        s = self.style
        ranges = [self.rows, *self.fades, s.size, s.letter_spacing, s.line_spacing, s.stroke, s.opacity, s.shadow_blur, *s.bar_shape]
        ranges += [c for c, _ in self.columns] + [size for (_, size), _ in s.fonts if size]
        if any(low > high for low, high in ranges) or any(low >= high for (low, high), _ in self.durations):
            raise ValueError("a range begins after its end")
        if odd := {name for name, _ in s.align} - set(ALIGN):
            raise ValueError(f"unknown alignment: {', '.join(sorted(map(str, odd)))}")
        if not self.durations or any(w <= 0 for o in (self.durations, self.columns, s.fonts, s.fills, s.strokes, s.bars) for _, w in o):
            raise ValueError("options need a positive weight")
        if not 1 <= self.frames <= 3 or self.attempts < 1:
            raise ValueError("an event has 1 to 3 frames and at least one attempt")


def draw_style(rng: random.Random, s: Style) -> dict:
    font, size = pick(rng, s.fonts)
    dx, dy = (rng.uniform(0.0, s.shadow_offset[0]), rng.uniform(0.0, s.shadow_offset[1])) if rng.random() < s.shadow else (0.0, 0.0)
    bar = (pick(rng, s.bars), *(rng.uniform(*r) for r in s.bar_shape)) if rng.random() < s.bar else None
    turn = rng.uniform(-s.degrees, s.degrees) if rng.random() < s.rotation else 0.0
    numbers = [rng.uniform(*r) for r in (size or s.size, s.letter_spacing, s.line_spacing, s.stroke, s.opacity)]
    align, fill, stroke, shadow = (pick(rng, o) for o in (s.align, s.fills, s.strokes, s.shadows or s.strokes))
    names = ("font_size", "letter_spacing", "line_spacing", "stroke_width", "opacity")
    return dict(zip(names, numbers, strict=True)) | {
        "font": font, "align": align, "fill": fill, "stroke": stroke, "shadow": shadow, "shadow_dx": dx, "shadow_dy": dy, "shadow_blur": rng.uniform(*s.shadow_blur), "bar": bar, "rotation": turn,
    }


def draw_fades(rng: random.Random, duration: int, plan: Plan) -> tuple[int, int]:
    if rng.random() >= plan.fade:
        return 0, 0
    both = [round(duration * rng.uniform(*r)) for r in plan.fades]
    if sum(both) > duration:
        scale = duration / sum(both)
        both = [round(x * scale) for x in both]
    return both[0], both[1]


def draw(index: int, seed: int, corpus: list[str], plan: Plan, fits: Callable[[dict], bool] | None = None) -> dict:
    """One event. ``fits`` may reject an attempt by any frame of the event; when none fits, ``attempt`` is null and the row is a failure."""
    own = seed + index * SEED_STEP
    rng = random.Random(own)
    low, high = pick(rng, plan.durations)
    duration = rng.randint(low, high)
    lines = 1 if rng.random() < plan.single_line else 2
    text = "\n".join(rng.choice(corpus) for _ in range(lines))
    fade_in, fade_out = draw_fades(rng, duration, plan)
    event = {"sample_index": index, "sample_seed": own, "duration_ms": duration, "text": text, "fade_in_ms": fade_in, "fade_out_ms": fade_out, "attempt": None}
    for attempt in range(plan.attempts):
        style = draw_style(rng, plan.style)
        left, right = pick(rng, plan.columns)
        row = event | style | {"x": rng.uniform(left, right), "y": rng.uniform(*plan.rows), "attempt": attempt}
        if fits is None or all(fits(row | {"frame": k}) for k in range(plan.frames)):
            return row
    return event


SCHEMA = (
    "sample_index long, sample_seed long, duration_ms long, text string, fade_in_ms long, fade_out_ms long, attempt int, font string, font_size double, letter_spacing double, line_spacing double, "
    "stroke_width double, opacity double, align string, fill array<int>, stroke array<int>, shadow array<int>, shadow_dx double, shadow_dy double, shadow_blur double, rotation double, x double, y double"
)
ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "array<int>": pa.list_(pa.int32())}
TYPES = {c.split()[0]: ARROW[c.split()[1]] for c in SCHEMA.split(", ")}
NAMES = list(TYPES)


def draw_samples(spark: SparkSession, n: int, seed: int, corpus: list[str], plan: Plan | None = None, fits: Callable[[dict], bool] | None = None) -> DataFrame:
    """``n`` events, spread over the cluster by index; the corpus is a configured list and goes to the workers."""
    ship(spark)
    plan = plan or Plan()
    if not corpus:
        raise ValueError("the corpus is empty")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [draw(i, seed, corpus, plan, fits) for i in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in TYPES.items()], NAMES)

    return spark.range(n).mapInArrow(run, SCHEMA)


def event_frames(events: DataFrame, frames: int, start: Column | None = None) -> DataFrame:
    """A row for each of an event's frames: its time, spread evenly over the event, and the opacity left by the fades.

    ``start`` is the event's begin in milliseconds, 0 if not given; events without an attempt have no frames.
    """
    begin = start if start is not None else F.lit(0)
    k = F.explode(F.sequence(F.lit(0), F.lit(frames - 1)))
    rows = events.where("attempt is not null").withColumn("_start", begin.cast("long")).withColumn("frame", k)
    at = representative_time(F.col("_start"), F.col("duration_ms"), frames, F.col("frame"))
    factor = fade_factor(at, F.col("_start"), F.col("_start") + F.col("duration_ms"), F.col("fade_in_ms"), F.col("fade_out_ms"))
    return rows.withColumn("frame_time_ms", at).withColumn("effective_opacity", F.col("opacity") * factor).drop("_start")


class Positions:
    """A corpus of so many lines that are drawn by number."""

    def __init__(self, n: int):
        self.n = n

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> str:
        return str(i)


def draw_samples_from(lines: DataFrame, text: str, order: list[str], n: int, seed: int, plan: Plan | None = None) -> DataFrame:
    """``draw_samples`` from a table of lines in the given order: numbers are drawn and the lines joined by them."""
    spark = lines.sparkSession
    rows = lines.where(F.col(text).isNotNull()).select(F.col(text).alias("line"), *order).orderBy(*order, text).select("line").rdd
    numbered = spark.createDataFrame(rows.zipWithIndex().map(lambda x: (x[0][0], x[1])), "line string, at long")
    drawn = draw_samples(spark, n, seed, Positions(rows.count()), plan)
    one = drawn.select("sample_index", F.posexplode(F.split("text", "\n")).alias("k", "at")).withColumn("at", F.col("at").cast("long")).join(numbered, "at")
    texts = one.groupBy("sample_index").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("l"))
    texts = texts.select("sample_index", F.array_join("l.line", "\n").alias("text"))
    return drawn.drop("text").join(texts, "sample_index").select(NAMES)


def random_crop(rng: random.Random, width: int, height: int, aspect_w: int, aspect_h: int) -> tuple[int, int, int, int]:
    """The largest rectangle of an aspect; one side is the frame's, along the other it lies at a random place."""
    size, ratio = np.array([width, height]), aspect_w / aspect_h
    free = int(ratio >= width / height)
    box = size.copy()
    box[free] = max(round(width / ratio if free else height * ratio), 1)
    start = np.zeros(2, int)
    start[free] = rng.randrange(max(size[free] - box[free] + 1, 1))
    return (*start.tolist(), *(start + box).tolist())


def crops(frames: DataFrame, targets: list[tuple[int, int, float]], seed: int) -> DataFrame:
    """Random crops of frames (video, frame, width, height); a video's frames share a generator, in frame order."""
    ship(frames.sparkSession)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rng, out = random.Random(seed), []
        for r in pdf.sort_values("frame").itertuples():
            w, h, _ = rng.choices(targets, weights=[t[2] for t in targets])[0]
            out.append((r.video, r.frame, *random_crop(rng, r.width, r.height, w, h)))
        return pd.DataFrame(out, columns=["video", "frame", "x0", "y0", "x1", "y1"])

    return frames.select("video", "frame", "width", "height").groupBy("video").applyInPandas(run, "video string, frame long, x0 long, y0 long, x1 long, y1 long")


def hash_uniform(*key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone: the same draws in any engine with SHA-256."""
    return F.conv(F.substring(F.sha2(F.concat_ws(":", *key), 256), 1, 8), 16, 10).cast("double") / float(2**32)


def between(u: Column, low: float, high: float) -> Column:
    return F.lit(low) + u * (high - low)
