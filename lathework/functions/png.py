"""PNG files from and to arrays of 8-bit grey, RGB or RGBA pixels."""

from __future__ import annotations

import struct
import zlib

import numpy as np

MARK = b"\x89PNG\r\n\x1a\n"
#: Fixed numbers of the format: colour kinds by channels.
KINDS = {1: 0, 2: 4, 3: 2, 4: 6}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(image: np.ndarray) -> bytes:
    pixels = np.ascontiguousarray(image if image.ndim == 3 else image[..., None], np.uint8)
    h, w, c = pixels.shape
    rows = np.concatenate((np.zeros((h, 1), np.uint8), pixels.reshape(h, w * c)), 1)
    head = struct.pack(">IIBBBBB", w, h, 8, KINDS[c], 0, 0, 0)
    return MARK + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes())) + _chunk(b"IEND", b"")


def decode(data: bytes) -> np.ndarray:
    """Pixels as (height, width, channels); interlaced, indexed and deeper files are refused."""
    if data[:8] != MARK:
        raise ValueError("no PNG file")
    at, body, head = 8, b"", b""
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        head, body = (part, body) if kind == b"IHDR" else (head, body + part if kind == b"IDAT" else body)
        at += 12 + size
    w, h, depth, kind, _, _, interlaced = struct.unpack(">IIBBBBB", head)
    channels = next((c for c, k in KINDS.items() if k == kind), 0)
    if depth != 8 or interlaced or not channels:
        raise ValueError("only plain 8-bit PNG files can be read")
    rows = np.frombuffer(zlib.decompress(body), np.uint8).reshape(h, 1 + w * channels)
    out = np.zeros((h + 1, w + 1, channels), np.int64)  # a rim of zeros above and to the left
    for y in range(h):
        line, how = rows[y, 1:].reshape(w, channels).astype(np.int64), rows[y, 0]
        own, above = out[y + 1], out[y]
        if how == 0:
            own[1:] = line
        elif how == 1:
            own[1:] = np.cumsum(line, 0) % 256
        elif how == 2:
            own[1:] = (line + above[1:]) % 256
        else:
            for x in range(w):
                a, b, c = own[x], above[x + 1], above[x]
                guess = (a + b) // 2
                if how == 4:  # the neighbour nearest to a + b - c: left, above, then between
                    near = np.abs(np.stack((b - c, a - c, a + b - 2 * c))).argmin(0)
                    guess = np.choose(near, (a, b, c))
                own[x + 1] = (line[x] + guess) % 256
    return out[1:, 1:].astype(np.uint8)
