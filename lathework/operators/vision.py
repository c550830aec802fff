"""Pixel kernels over arrays: text regions, dilation, pairing checks, hashes; images are (height, width, channels)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Fixed weights of the grey value.
GREY = np.array([299, 587, 114])


def grey(image: np.ndarray) -> np.ndarray:
    return image if image.ndim == 2 else ((image[..., :3].astype(np.int64) @ GREY + 500) // 1000).astype(np.uint8)


def windows(a: np.ndarray, radius: int, fill: int) -> np.ndarray:
    padded = np.pad(a, radius, constant_values=fill)
    return np.lib.stride_tricks.sliding_window_view(padded, (2 * radius + 1,) * 2)


def dilate(mask: np.ndarray, radius: int) -> np.ndarray:
    """Square dilation of a mask."""
    return windows(mask.astype(np.uint8), radius, 0).max((2, 3)) > 0 if radius else mask > 0


def close_gaps(mask: np.ndarray, radius: int) -> np.ndarray:
    grown = dilate(mask, radius).astype(np.uint8)
    return windows(grown, radius, 1).min((2, 3)) > 0 if radius else grown > 0


def edges(image: np.ndarray) -> np.ndarray:
    """Difference of each pixel from its neighbours, 8 times it less their sum, within 0 and 255; none at the rim."""
    g = grey(image).astype(np.int64)
    out = np.zeros_like(g)
    if min(g.shape) > 2:
        w = np.lib.stride_tricks.sliding_window_view(g, (3, 3))
        out[1:-1, 1:-1] = np.clip(9 * g[1:-1, 1:-1] - w.sum((2, 3)), 0, 255)
    return out


def segments(values: np.ndarray, least: int, gap: int) -> list[tuple[int, int]]:
    """Half-open runs of true values; runs at most ``gap`` apart are one, then those shorter than ``least`` go."""
    at = np.flatnonzero(values)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) - 1 > gap)
    starts, ends = at[np.append(0, cut + 1)], at[np.append(cut, len(at) - 1)] + 1
    return [(int(s), int(e)) for s, e in zip(starts, ends, strict=True) if e - s >= least]


def text_regions(image: np.ndarray, threshold: int = 60, radius: int = 2, row_share: float = 0.05, least: int = 6, gap: int = 4) -> list[tuple[int, int, int, int, float]]:
    """Boxes of dense edges: rows with enough of them, then columns within; with the share of edge pixels."""
    mask = close_gaps(edges(image) > threshold, radius)
    out = []
    for y0, y1 in segments(mask.mean(1) >= row_share, least, gap):
        for x0, x1 in segments(mask[y0:y1].any(0), least, 4 * gap):
            out.append((x0, y0, x1, y1, float(mask[y0:y1, x0:x1].mean())))
    return out


def alpha_box(alpha: np.ndarray) -> tuple[int, int, int, int]:
    ys, xs = np.nonzero(alpha)
    if not len(ys):
        raise ValueError("the mask is empty")
    return int(xs.min()), int(ys.min()), int(xs.max()) + 1, int(ys.max()) + 1


@dataclass(frozen=True)
class Pairing:
    ok: bool
    same_size: bool
    max_diff_outside: int
    changed_box: tuple[int, int, int, int] | None


def check_pairing(clean: np.ndarray, rendered: np.ndarray, mask: np.ndarray) -> Pairing:
    """Whether two images differ within the mask only, and where they do."""
    if clean.shape != rendered.shape or clean.shape[:2] != mask.shape:
        return Pairing(False, False, 255, None)
    diff = np.abs(clean.astype(np.int64) - rendered.astype(np.int64)).max(2)
    outside = int(diff[mask == 0].max(initial=0))
    return Pairing(outside == 0, True, outside, alpha_box(diff) if diff.any() else None)


def kernel(x: np.ndarray) -> np.ndarray:
    """Lanczos window of three lobes."""
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


def weights(size: int, wanted: int) -> np.ndarray:
    """Shares of the pixels of a row of ``size`` in each of ``wanted`` pixels; the window widens when it shrinks."""
    step = size / wanted
    wide = max(step, 1.0)
    out = kernel((np.arange(size)[None] + 0.5 - (np.arange(wanted)[:, None] + 0.5) * step) / wide)
    return out / out.sum(1, keepdims=True)


def resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """The image in another size, by Lanczos windows along columns, then rows."""
    if image.shape[:2] == (height, width):
        return image
    across = np.einsum("xw,hw...->hx...", weights(image.shape[1], width), image.astype(float))
    across = np.clip(np.rint(across), 0, 255)
    return np.clip(np.rint(np.einsum("yh,hx...->yx...", weights(image.shape[0], height), across)), 0, 255).astype(np.uint8)


def difference_hash(image: np.ndarray) -> str:
    """64 bits: whether each of 8 x 8 cells is darker than its right neighbour, in the grey image at 9 x 8."""
    small = resize(grey(image), 8, 9).astype(int)
    bits = (small[:, 1:] > small[:, :-1]).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def share_of(box, shape) -> tuple[float, float, float, float]:
    """A pixel box as shares of the image's width and height."""
    h, w = shape[:2]
    return box[0] / w, box[1] / h, box[2] / w, box[3] / h


def foreground(image: np.ndarray, box, threshold: int = 40) -> np.ndarray:
    """Edges within a box, cut to the image; a single false pixel if nothing of it lies there."""
    x0, y0, x1, y1 = (min(max(int(v), 0), image.shape[1 - i % 2]) for i, v in enumerate(box))
    part = image[y0:y1, x0:x1]
    return edges(part) >= threshold if part.size else np.zeros((1, 1), bool)


def mask_iou(a: np.ndarray, b: np.ndarray) -> float:
    h, w = max(a.shape[0], b.shape[0]), max(a.shape[1], b.shape[1])
    a, b = (np.pad(m > 0, ((0, h - m.shape[0]), (0, w - m.shape[1]))) for m in (a, b))
    union = (a | b).sum()
    return float((a & b).sum() / union) if union else 1.0


def rotate_points(points: np.ndarray, degrees: float) -> np.ndarray:
    """Points turned about the origin, y downwards, anticlockwise as seen."""
    r = np.radians(degrees)
    return points @ np.array([[np.cos(r), -np.sin(r)], [np.sin(r), np.cos(r)]])
