"""NumPy views of Arrow text batches: words, hashes and shingles of many documents at once.

A block is a run of documents joined by one separator byte; every function works on the whole block, so the cost is a
few array passes per byte and no Python step per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text that one block holds, unless a single document is longer.
BLOCK_BYTES = 1 << 19

#: Fixed odd multipliers of the polynomial hashes and of the finaliser.
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX_1, MIX_2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(pred) -> np.ndarray:
    return np.array([bool(pred(b)) for b in range(256)])


#: Bytes of words between ASCII white space, and of words made of digits, a-z and non-ASCII characters.
NOT_SPACE = table(lambda b: not (b == 0x20 or 0x09 <= b <= 0x0D))
ALNUM = table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> U64(30))) * MIX_1
    x = (x ^ (x >> U64(27))) * MIX_2
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.clear()

    def clear(self) -> None:
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, BLOCK_BYTES + BLOCK_BYTES // 4)
            self.up, self.down = (np.concatenate(([U64(1)], np.cumprod(np.full(n - 1, b, U64), dtype=U64))) for b in (self.base, self.inverse))
        return self.up, self.down


_POWERS = {b: Powers(b) for b in (BASE_A, BASE_B)}


def forget() -> None:
    """Gives the tables of powers back."""
    for p in _POWERS.values():
        p.clear()


def prefix(buf: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """Running sums from which ``spans`` takes the hash of any span."""
    up, _ = _POWERS[base].get(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * up[: len(buf)], out=out[1:])
    return out


def spans(run: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = BASE_A) -> np.ndarray:
    """Hash of each span [start, end) of the bytes under ``run``; equal bytes give equal hashes wherever they stand."""
    _, down = _POWERS[base].get(len(run))
    return mix((run[end] - run[start]) * down[start] + (end - start).astype(U64) * U64(BASE_B))


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def blocks(docs: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes; a longer document is a block of its own."""
    at, held = 0, 0
    for i, d in enumerate(docs):
        if i > at and held + len(d) > limit:
            yield at, i
            at, held = i, 0
        held += len(d)
    if at < len(docs):
        yield at, len(docs)


class Block:
    """Documents joined by a blank, in front of each and at the end; ``first`` holds where each text starts."""

    def __init__(self, docs: list[bytes], lower: bool = True):
        joined = b" " + b" ".join(docs) + b" "
        self.raw = joined.translate(LOWER) if lower else joined
        self.buf = np.frombuffer(self.raw, np.uint8)
        self.size = np.fromiter(map(len, docs), np.int64, len(docs))
        self.first = np.cumsum(self.size + 1) - self.size
        self.n = len(docs)

    def words(self, kind: np.ndarray) -> None:
        """Sets ``start``, ``end``, ``word`` (hash) and ``doc`` of each word, and ``at``: where each document's words begin."""
        inside = kind[self.buf]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        self.word = spans(prefix(self.buf), self.start, self.end)
        self.at = np.searchsorted(self.start, np.append(self.first, len(self.buf)))
        self.count = np.diff(self.at)
        self.doc = np.repeat(np.arange(self.n), self.count)


def shingles(block: Block, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``width``-word shingles of each document and where each document's begin.

    With fewer words the whole sequence is the one shingle; without words there is none.
    """
    w = block.word
    n = np.where(block.count >= width, block.count - width + 1, np.minimum(block.count, 1))
    at = np.concatenate(([0], np.cumsum(n)))
    begin = np.repeat(block.at[:-1] - at[:-1], n) + np.arange(at[-1])
    size = np.repeat(np.minimum(block.count, width), n)
    h = np.zeros(len(begin), U64)
    for k in range(width):
        use = size > k
        h = np.where(use, mix(h * U64(BASE_B) + w[np.minimum(begin + k, max(len(w) - 1, 0))] + U64(k + 1)), h) if len(w) else h
    return h, at
