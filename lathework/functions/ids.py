"""Content ids: canonical JSON, SHA-256, perceptual hashes and their distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_json(**fields: Column) -> Column:
    """Compact JSON with sorted keys; nulls stay. Byte-equal to the usual dump for integers, strings and arrays."""
    return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), {"ignoreNullFields": "false"})


def content_id(**fields: Column) -> Column:
    return F.sha2(canonical_json(**fields), 256)


def sample_id(version: Column, video: Column, frame: Column, pts: Column, crop: Column, event: Column, style_seed: Column) -> Column:
    """Id of a sample from the seven fields that determine it; no path takes part."""
    return content_id(crop_xywh=crop, dataset_version=version, event_id=event, native_frame_index=frame, pts=pts, style_seed=style_seed, video_sha256=video)


def event_id(text: Column, start_ms: Column, seed: Column, style_seed: Column) -> Column:
    return content_id(seed=seed, start_time_ms=start_ms, style_seed=style_seed, text_raw=text)


def hamming(a: Column, b: Column) -> Column:
    """Distance of two 64-bit hashes held as longs."""
    return F.bit_count(a.bitwiseXOR(b))


def hash_of_hex(c: Column) -> Column:
    """A 16-digit hex hash as long; two halves, since an unsigned 64-bit number doesn't fit."""
    high, low = (F.conv(F.substring(c, i, 8), 16, 10).cast("long") for i in (1, 9))
    return F.shiftleft(high, 32).bitwiseOR(low)


def difference_hash(cells: Column, rows: int = 8, columns: int = 8) -> Column:
    """Bits of an array of ``rows`` x ``columns`` values, first bit highest: is each cell's right neighbour larger?"""
    at = F.filter(F.sequence(F.lit(0), F.lit(rows * columns - 1)), lambda i: i % columns < columns - 1)
    bits = F.transform(at, lambda i: F.when(F.get(cells, i + 1) > F.get(cells, i), F.lit(1)).otherwise(0).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda x, b: F.shiftleft(x, 1).bitwiseOR(b))


def bucket32(key: Column) -> Column:
    """The first 32 bits of a key's SHA-256, evenly spread and the same in every engine."""
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
