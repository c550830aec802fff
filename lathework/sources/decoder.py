"""A video decoder's programs as ``Media``: probe, frame log, scene cuts and frames from their output."""

from __future__ import annotations

import hashlib
import json
import re
import subprocess
from dataclasses import dataclass
from fractions import Fraction
from functools import cached_property
from importlib import metadata


def ran(*command: str) -> subprocess.CompletedProcess:
    """A program's finished run; its last words are the error if it fails."""
    done = subprocess.run(command, capture_output=True, check=False)
    if done.returncode:
        raise OSError(f"{command[0]} failed: {done.stderr.decode(errors='replace').strip()[-400:]}")
    return done


def first_line(*command: str) -> str:
    """First line of what a program says, empty if it can't be run."""
    try:
        return (ran(*command).stdout.decode(errors="replace").splitlines() or [""])[0]
    except OSError:
        return ""


def versions(packages: tuple[str, ...] = ("pyspark", "numpy", "pyarrow"), programs: tuple[str, ...] = ("ffmpeg", "ffprobe", "git")) -> dict[str, str]:
    """Versions of packages and programs; what is not installed has none."""
    found = {}
    for p in packages:
        try:
            found[p] = metadata.version(p)
        except metadata.PackageNotFoundError:
            found[p] = ""
    return found | {p: first_line(p, "--version" if p == "git" else "-version") for p in programs}


def ratio(text: str | None) -> Fraction:
    """``n/d``; 0 for what is no fraction or has no positive denominator."""
    n, _, d = (text or "").partition("/")
    try:
        return Fraction(int(n), int(d or 1)) if int(d or 1) > 0 else Fraction(0)
    except ValueError:
        return Fraction(0)


@dataclass(frozen=True)
class Programs:
    """A video by its path, and the programs that read it."""

    path: str
    decoder: str = "ffmpeg"
    prober: str = "ffprobe"

    def sha256(self) -> str:
        with open(self.path, "rb") as f:
            return hashlib.file_digest(f, "sha256").hexdigest()

    def probe(self) -> dict:
        doc = json.loads(ran(self.prober, "-v", "error", "-print_format", "json", "-show_format", "-show_streams", self.path).stdout)
        video = next((s for s in doc.get("streams", []) if s.get("codec_type") == "video"), None)
        if video is None:
            raise ValueError(f"{self.path} has no video stream")
        avg, rate, base = (ratio(video.get(k)) for k in ("avg_frame_rate", "r_frame_rate", "time_base"))
        base = base or Fraction(1, 1000)
        seconds = doc.get("format", {}).get("duration")
        return {
            "duration_seconds": float(seconds) if seconds not in (None, "N/A") else None,
            "video": {
                "width": video.get("width"), "height": video.get("height"), "codec_name": video.get("codec_name"), "time_base": {"num": base.numerator, "den": base.denominator},
                "avg_frame_rate": {"avg_num": avg.numerator, "avg_den": avg.denominator}, "r_frame_rate": {"r_num": rate.numerator, "r_den": rate.denominator}, "is_vfr": avg == 0 or avg != rate,
            },
        }

    def _log(self, chain: str) -> list[tuple[int, int, float]]:
        said = ran(self.decoder, "-i", self.path, "-vf", chain, "-f", "null", "-").stderr.decode(errors="replace")
        found = re.findall(r"\bn:\s*(\d+)\s.*?\bpts:\s*(-?\d+)\s.*?\bpts_time:\s*(-?[\d.]+)", said)
        return [(int(n), int(pts), float(t)) for n, pts, t in found]

    @cached_property
    def _frames(self) -> list[tuple[int, int, float]]:
        return self._log("showinfo")

    def timeline(self) -> list[tuple[int, int, float]]:
        return self._frames

    def cuts(self, threshold: float) -> list[float]:
        return sorted(t for _, _, t in self._log(f"select='gt(scene,{threshold})',showinfo"))

    def pngs(self, frames: list[int]) -> bytes:
        chosen = "+".join(f"eq(n,{k})" for k in frames)
        return ran(self.decoder, "-i", self.path, "-vf", f"select='{chosen}'", "-fps_mode", "passthrough", "-frames:v", str(len(frames)), "-f", "image2pipe", "-c:v", "png", "-").stdout
