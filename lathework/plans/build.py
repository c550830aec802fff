"""From videos to samples: ingest, generate and export, each a stage that can be resumed.

Decoding is not done here: a ``Media`` is anything that tells a video's probe, frame log and cuts and gives its frames,
for instance by calling a decoder's program. Videos are ingested and samples rendered on the executors.
"""

from __future__ import annotations

import hashlib
import json
import random
from collections.abc import Callable, Iterator, Sequence
from dataclasses import asdict, dataclass, field
from pathlib import Path
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lathework.functions import png
from lathework.operators import registry, rendering, sampling, vision
from lathework.plans import export, runner
from lathework.shipping import ship
from lathework.sources.readers import split_pngs
from lathework.sources.writers import write_table


class Media(Protocol):
    """One video, opened by its path."""

    def sha256(self) -> str: ...

    def probe(self) -> dict: ...

    def timeline(self) -> list[tuple[int, int, float]]:
        """Number, ticks and seconds of every frame."""

    def cuts(self, threshold: float) -> list[float]:
        """Times at which the picture changes by more than the threshold."""

    def pngs(self, frames: list[int]) -> bytes:
        """The given frames, each once and in order, as PNG files one after another."""


class Hasher(Protocol):
    """Near hash of an image; ``vision.difference_hash`` is one."""

    def __call__(self, image: np.ndarray) -> str: ...


class Detector(Protocol):
    """Boxes of text of an image with a confidence; ``vision.text_regions`` is one."""

    def __call__(self, image: np.ndarray) -> list[tuple[int, int, int, int, float]]: ...


class Adapter(Protocol):
    """A platform: what there is, and what an item is called and holds."""

    def discover(self, request: dict) -> list[dict]: ...

    def metadata(self, item: dict) -> dict: ...

    def download(self, item: dict, to: Path) -> None: ...


def frames_of(media: Media, wanted: Sequence[int]) -> list[np.ndarray]:
    """Frames in the order asked for, repeated ones too, from one pass of the decoder; it must give as many as were asked."""
    once = sorted(set(wanted))
    images = [png.decode(x)[..., :3] for x in split_pngs(media.pngs(once))] if once else []
    if len(images) != len(once):
        raise ValueError(f"{len(once)} frames were asked for, the decoder gave {len(images)}")
    by_number = dict(zip(once, images, strict=True))
    return [by_number[k] for k in wanted]


@dataclass(frozen=True)
class Ingest:
    scene_threshold: float = 0.3
    frames_per_scene: int = 1
    targets: tuple[tuple[int, int, float], ...] = ((1280, 720, 1.0),)
    random_crops: bool = False
    seed: int = 0


@dataclass(frozen=True)
class Build:
    dataset_version: str = "v1"
    seed: int = 0
    events: int = 5
    platform: str = "unknown"
    ingest: Ingest = field(default_factory=Ingest)
    plan: sampling.Plan = field(default_factory=sampling.Plan)
    corpus: tuple[str, ...] = ("Lorem ipsum", "dolor sit amet")
    export_parquet: bool = True


def scene_bounds(times: list[float], cuts: list[float], duration: float) -> list[tuple[int, int]]:
    """Frames of each scene: from the first at or after a cut to that of the next, one frame at least."""
    edge = np.searchsorted(times, [0.0, *sorted(cuts), duration])
    return [(min(int(a), len(times) - 1), max(int(z), min(int(a), len(times) - 1) + 1)) for a, z in zip(edge, edge[1:], strict=False)]


def picks(start: int, end: int, count: int) -> list[int]:
    """Frames of a scene that stand for it: the middle one, or evenly spread ones with both ends."""
    n = end - start
    if count == 1 or n == 1:
        return [start + (n // 2 if count == 1 else 0)]
    return sorted({start + round(i * (n - 1) / (count - 1)) for i in range(count)}) if n > count else list(range(start, end))


def ingest_video(media: Media, config: Ingest, keep: Callable[[str, bytes], None]) -> dict:
    """Manifest of a video: probe, scenes, the frames that ``keep`` was given as PNG files, and what failed, frame by frame."""
    line, about = media.timeline(), media.probe()
    if any(b[1] < a[1] for a, b in zip(line, line[1:], strict=False)):
        raise ValueError("the ticks of the video's frames fall")
    times = [t for _, _, t in line]
    bounds = scene_bounds(times, media.cuts(config.scene_threshold), about.get("duration_seconds") or (times[-1] if times else 0.0)) if line else []
    rng, digest = random.Random(config.seed), media.sha256()
    frames, failures = [], []
    for scene, (start, end) in enumerate(bounds):
        for k in picks(start, min(end, len(line)), config.frames_per_scene):
            n, pts, t = line[k]
            uri = f"frames/{digest[:16]}-{len(frames):05d}.png"
            try:
                (image,) = frames_of(media, [n])
                h, w = image.shape[:2]
                tw, th, _ = rng.choices(config.targets, weights=[x[2] for x in config.targets])[0]
                box = sampling.random_crop(rng, w, h, tw, th) if config.random_crops else middle_crop(w, h, tw, th)
                data = png.encode(vision.resize(image[box[1] : box[3], box[0] : box[2]], th, tw))
                keep(uri, data)
            except Exception as e:  # one frame must not end the video
                failures.append({"stage": "extract", "input_ref": f"scene={scene},frame={n}", "error_type": type(e).__name__, "message": str(e), "retryable": True})
                continue
            crop = [box[0], box[1], box[2] - box[0], box[3] - box[1]]
            frames.append({"scene_index": scene, "native_frame_index": n, "pts": pts, "pts_time_seconds": t, "timestamp_ms": round(t * 1000), "crop_xywh": crop, "target_size": [tw, th], "crop_mode": "random" if config.random_crops else "center", "uri": uri, "image_sha256": hashlib.sha256(data).hexdigest()})
    scenes = [{"index": i, "start_frame": a, "end_frame_exclusive": z, "start_time_ms": round(times[a] * 1000)} for i, (a, z) in enumerate(bounds)]
    return {"video_sha256": digest, "probe": about, "scenes": scenes, "frames": frames, "failures": failures}


def middle_crop(width: int, height: int, aspect_w: int, aspect_h: int) -> tuple[int, int, int, int]:
    """The largest rectangle of an aspect in the middle of a frame."""
    scale = min(width / aspect_w, height / aspect_h)
    w, h = min(width, max(round(aspect_w * scale), 1)), min(height, max(round(aspect_h * scale), 1))
    x, y = (width - w) // 2, (height - h) // 2
    return x, y, x + w, y + h


def saver(folder: str) -> Callable[[str, bytes], None]:
    def keep(uri: str, data: bytes) -> None:
        path = Path(folder) / uri
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    return keep


def ingest(spark: SparkSession, videos: list[str], open_media: Callable[[str], Media], config: Ingest, folder: str) -> DataFrame:
    """``video, manifest, error`` for each video, on the executors; frames go to the folder, which they share."""
    ship(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for video in pdf["video"]:
                try:
                    row = (video, json.dumps(ingest_video(open_media(video), config, saver(folder))), None)
                except Exception as e:  # one video must not end the others
                    row = (video, None, f"{type(e).__name__}: {e}")
                yield pd.DataFrame([row], columns=["video", "manifest", "error"])

    one_each = spark.createDataFrame([(v,) for v in videos], "video string").repartition(max(len(videos), 1))
    return one_each.mapInPandas(run, "video string, manifest string, error string")


def generate(spark: SparkSession, frames: list[dict], config: Build, folder: str, detector: Detector | None = None) -> DataFrame:
    """Events drawn, rendered on their frame and checked, on the executors: a row for each sample, its three images and
    its record in a folder of its own. Event i takes frame i modulo their number; an event that never fits is a row
    without ``frame``. Frames are records of ``uri, crop_xywh, target_size, video_sha256, native_frame_index, pts, timestamp_ms``.
    """
    ship(spark)
    if not frames:
        raise ValueError("there are no frames")
    lines = list(config.corpus)
    plan, seed, version = config.plan, config.seed, config.dataset_version

    def one(index: int) -> Iterator[dict]:
        at = frames[index % len(frames)]
        clean = png.decode((Path(folder) / at["uri"]).read_bytes())[..., :3]
        if list(clean.shape[1::-1]) != list(at["target_size"]):
            raise ValueError(f"{at['uri']} has not the size of its transform")
        made: dict[int, rendering.Rendered] = {}
        boxes = [vision.share_of(b[:4], clean.shape) for b in detector(clean)] if detector else []

        def fits(row: dict) -> bool:
            try:
                made[row["frame"]] = r = rendering.render(clean, row["text"], (row["x"], row["y"]), color=row["fill"][:3], opacity=row["opacity"], align=row["align"], degrees=row["rotation"])
            except ValueError:
                return False
            x0, y0, x1, y1 = vision.share_of(r.effect_box, clean.shape)
            apart = all(b[2] <= x0 or x1 <= b[0] or b[3] <= y0 or y1 <= b[1] for b in boxes)
            return r.pairing.ok and apart and 0.6 <= (y0 + y1) / 2 <= 0.9

        row = sampling.draw(index, seed, lines, plan, fits)
        if row["attempt"] is None:
            yield {"sample_index": index, "frame": None, "record": None}
            return
        for k in range(plan.frames):
            r, name = made[k], f"samples/{index * plan.frames + k:05d}"
            record = {**row, "event_frame_index": k, "effect_bbox_xyxy": list(r.effect_box), "pairing_ok": r.pairing.ok, "source": at, "build": {"dataset_version": version, "seed": row["sample_seed"]}}
            for file, image in (("rendered", r.image), ("alpha", r.alpha), ("mask", r.mask * 255)):
                saver(folder)(f"{name}/{file}.png", png.encode(image))
            text = json.dumps(record, ensure_ascii=False)
            saver(folder)(f"{name}/sample.json", text.encode())
            yield {"sample_index": index, "frame": k, "record": text}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [r for i in pdf["id"] for r in one(int(i))]
            yield pd.DataFrame(rows, columns=["sample_index", "frame", "record"]).astype({"frame": "Int64"})

    return spark.range(config.events).mapInPandas(run, "sample_index long, frame long, record string")


def digest_of(value) -> str:
    return hashlib.sha256(json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str).encode()).hexdigest()


def build(spark: SparkSession, videos: list[str], open_media: Callable[[str], Media], config: Build, folder: Path, *, sources: DataFrame | None = None, source_id: str | None = None, at: str | None = None, force: bool = False) -> runner.Run:
    """Ingest, generate and export into a folder. A run of the same videos and settings goes on where it stopped; a
    source that may not be used ends it before it begins."""
    if source_id is not None:
        found = registry.authorised(sources.where(F.col("source_id") == source_id), F.lit(at).cast("date") if at else F.current_date()).first()
        if found is None or not found.authorized:
            raise PermissionError(f"{source_id}: {'; '.join(found.reasons) if found else 'not in the registry'}")
    hashes = {"ingest": digest_of(asdict(config.ingest)), "generate": digest_of(asdict(config.plan)), "export": digest_of(config.export_parquet)}
    name = runner.run_id(version=config.dataset_version, seed=config.seed, inputs=[open_media(v).sha256() for v in videos], stages=hashes, events=config.events)
    manifest_file = folder / "manifest.json"

    def do_ingest() -> list[str]:
        rows = ingest(spark, videos, open_media, config.ingest, str(folder)).collect()  # a row for each video, without images
        manifests = [json.loads(r.manifest) for r in rows if r.manifest]
        bad = [r.error for r in rows if r.error] + [f["message"] for m in manifests for f in m["failures"]]
        manifest_file.write_text(json.dumps(manifests, ensure_ascii=False, indent=1))
        if bad:
            raise RuntimeError(f"{len(bad)} failures: {bad[0]}")
        return [str(manifest_file)]

    def do_generate() -> list[str]:
        frames = [f | {"video_sha256": m["video_sha256"]} for m in json.loads(manifest_file.read_text()) for f in m["frames"]]
        write_table(generate(spark, frames, config, str(folder)), f"{folder}/records")
        return [f"{folder}/records"]

    def do_export() -> list[str]:
        table = spark.read.option("multiLine", True).json(str(manifest_file))
        for part, df in export.flat_manifest(table.where("size(failures) = 0").withColumn("failures", F.array().cast("array<struct<stage:string>>"))).items():
            write_table(df, f"{folder}/parquet/{part}")
        write_table(spark.read.parquet(f"{folder}/records"), f"{folder}/parquet/samples")
        return [f"{folder}/parquet"]

    stages = [("ingest", do_ingest, hashes["ingest"]), ("generate", do_generate, hashes["generate"])]
    folder.mkdir(parents=True, exist_ok=True)
    return runner.execute(folder, name, stages + ([("export", do_export, hashes["export"])] if config.export_parquet else []), force=force)
