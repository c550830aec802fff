"""Boxes as column expressions; a box is four columns x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]

#: Fixed values of the geometric roles: subtitles below this height, watermarks in corners and of small area.
SUBTITLE_FROM, CORNER, SMALL = 0.55, 0.25, 0.06


def box(c: Column) -> Box:
    return tuple(F.get(c, i) for i in range(4))


def area(b: Box) -> Column:
    return F.greatest(b[2] - b[0], F.lit(0.0)) * F.greatest(b[3] - b[1], F.lit(0.0))


def iou(a: Box, b: Box) -> Column:
    wide = F.greatest(F.least(a[2], b[2]) - F.greatest(a[0], b[0]), F.lit(0.0))
    high = F.greatest(F.least(a[3], b[3]) - F.greatest(a[1], b[1]), F.lit(0.0))
    union = area(a) + area(b) - wide * high
    return F.when(union <= 0, 0.0).otherwise(F.try_divide(wide * high, union))


def intersects(a: Box, b: Box) -> Column:
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def widened(b: Box, margin: float) -> Box:
    low = tuple(F.greatest(F.lit(0.0), x - margin) for x in b[:2])
    return (*low, *(F.least(F.lit(1.0), x + margin) for x in b[2:]))


def in_corner(b: Box) -> Column:
    x, y = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
    side = lambda v: (v <= CORNER) | (v >= 1 - CORNER)
    return side(x) & side(y) & (area(b) <= SMALL)


def geometric_role(b: Box) -> Column:
    return F.when((b[1] + b[3]) / 2 >= SUBTITLE_FROM, "subtitle").when(in_corner(b), "watermark").otherwise("scene_text")


def final_role(role: Column, switched: Column, b: Box) -> Column:
    """Changing text is a subtitle; a subtitle that never changes is a watermark or scene text."""
    still = F.when(in_corner(b), "watermark").otherwise("scene_text")
    return F.when(switched, "subtitle").when(role == "subtitle", still).otherwise(role)


def center_crop(width: Column, height: Column, target_w: Column, target_h: Column) -> Column:
    """Largest centred rectangle of the target's aspect, as x0, y0, x1, y1 and true width and height."""
    wide, one = width * target_h > target_w * height, F.lit(1).cast("long")
    w = F.when(wide, F.greatest(F.rint(height * target_w / target_h.cast("double")).cast("long"), one)).otherwise(width.cast("long"))
    h = F.when(wide, height.cast("long")).otherwise(F.greatest(F.rint(width * target_h / target_w.cast("double")).cast("long"), one))
    x, y = F.floor((width - w) / 2), F.floor((height - h) / 2)
    return F.struct(x.alias("x0"), y.alias("y0"), (x + w).alias("x1"), (y + h).alias("y1"), w.alias("w"), h.alias("h"))
