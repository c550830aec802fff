"""The text rules over arrays of code points, all texts of a slice at once; equal to the rules of ``text``."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are held as arrays at once (a longer text is taken whole), and what stands before, between and after texts.
SLICE, END = 1 << 20, 0x110000

#: Of an array of code points: the new ones, and which of them stay.
Kernel = Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]


def among(c: np.ndarray, chars: str) -> np.ndarray:
    """Whether each code point is one of ``chars``."""
    known = np.zeros(max(map(ord, chars)) + 2, bool)
    known[[ord(x) for x in chars]] = True
    return known[np.minimum(c, len(known) - 1)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run; the mask's ends are unset."""
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    return edges[::2] + 1, edges[1::2]


def outside(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in none of the runs."""
    steps = np.zeros(size + 1, np.int8)
    steps[first] = 1
    steps[last + 1] = -1
    return np.cumsum(steps[:-1], dtype=np.int8) == 0


def mapped(old: str, new: str) -> Kernel:
    low, high = min(map(ord, old)), max(map(ord, old))
    table = np.arange(low, high + 1, dtype=np.uint32)
    table[[ord(x) - low for x in old]] = [ord(x) for x in new]

    def run(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, at = c.copy(), np.flatnonzero((c >= low) & (c <= high))
        out[at] = table[c[at] - low]
        return out, np.ones(len(c), bool)

    return run


def newlines(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    back, kept = c == 13, np.ones(len(c), bool)
    kept[:-1] = ~(back[:-1] & (c[1:] == 10))
    return np.where(back, np.uint32(10), c), kept


def whitespace(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    blank, kept = (c == 32) | (c == 9), np.ones(len(c), bool)
    kept[1:] = ~(blank[1:] & blank[:-1])
    return np.where(blank, np.uint32(32), c), kept


def punctuation_spacing(closing: str, opening: str) -> Kernel:
    def run(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = runs((c == 32) | (c == 9))
        beside = among(c[last + 1], closing) | among(c[first - 1], opening)
        return c, outside(len(c), first[beside], last[beside])

    return run


def strip_lines(blanks: str) -> Kernel:
    def run(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, last = runs(among(c, blanks))
        feeds = np.flatnonzero(c == 10)
        edge = (c[first - 1] == END) | (c[last + 1] == END)
        between = ~edge & (np.searchsorted(feeds, last, "right") > np.searchsorted(feeds, first))
        kept, out = outside(len(c), first[edge | between], last[edge | between]), c.copy()
        kept[first[between]], out[first[between]] = True, 10
        return out, kept

    return run


def slices(texts: pa.Array) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of some texts and their number, in turn; a null counts as an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    low = 0
    while low < len(texts):
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + SLICE, "right")) - 1)
        part, ends = data[bounds[low] : bounds[high]], bounds[low : high + 1] - bounds[low]
        try:
            found = part.tobytes().decode().encode("utf-32-le")
            ends = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[ends]
        except UnicodeDecodeError:  # what isn't UTF-8 becomes U+FFFD, text by text
            each = [part[a:b].tobytes().decode(errors="replace") for a, b in zip(ends, ends[1:])]
            found, ends = "".join(each).encode("utf-32-le"), np.cumsum([0, *map(len, each)])
        yield np.insert(np.frombuffer(found, "<u4"), ends, END), high - low
        low = high


def apply(c: np.ndarray, kernels: list[Kernel]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The code points after all rules, and for each rule whether it changed each text."""
    hits = []
    for kernel in kernels:
        out, kept = kernel(c)
        changed = np.flatnonzero((out != c) | ~kept)
        hits.append(np.diff(np.searchsorted(changed, np.flatnonzero(c == END))) > 0)
        c = out[kept] if len(changed) else c
    return c, hits


def normalized(texts: pa.Array, kernels: list[Kernel]) -> pa.Array:
    parts, sizes = [], [np.zeros(1, np.int64)]
    for c, _ in slices(texts):
        c, _ = apply(c, kernels)
        wide = 1 + (c >= 0x80).astype(np.int8) + (c >= 0x800) + (c >= 0x10000)
        wide[c == END] = 0
        sizes.append(np.diff(np.concatenate([[0], np.cumsum(wide)])[np.flatnonzero(c == END)]))
        parts.append(c[c != END].astype("<u4").tobytes().decode("utf-32-le").encode())
    ends = np.cumsum(np.concatenate(sizes), dtype=np.int64)
    out = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(parts))])
    return pc.if_else(texts.is_valid(), out, pa.scalar(None, pa.large_string())).cast(pa.string())


def changed_by(texts: pa.Array, kernels: dict[str, Kernel]) -> pa.Array:
    """Names of the rules that changed each text, in order."""
    found = [np.stack(apply(c, list(kernels.values()))[1], axis=1) for c, _ in slices(texts)]
    hits = np.concatenate([np.zeros((0, len(kernels)), bool), *found])
    ends = np.concatenate([[0], np.cumsum(hits.sum(axis=1))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(list(kernels), pa.string()).take(pa.array(np.nonzero(hits)[1])))
