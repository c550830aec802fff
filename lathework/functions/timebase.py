"""Time bases, events, frames and even picks as column expressions; halves round to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ticks_to_ms(ticks: Column, num: Column, den: Column) -> Column:
    return F.rint(ticks * num * 1000 / den.cast("double")).cast("long")


def ms_to_pts(ms: Column, num: Column, den: Column) -> Column:
    return F.rint(ms * den / (num * 1000).cast("double")).cast("long")


def parse_fraction(c: Column) -> Column:
    """``n/d`` as struct; (0, 1) for what is no fraction or has no positive denominator."""
    part = F.split(c, "/")
    num, den = (F.try_element_at(part, F.lit(i)).try_cast("long") for i in (1, 2))
    den = F.when(F.size(part) == 1, F.lit(1).cast("long")).otherwise(den)
    ok = num.isNotNull() & den.isNotNull() & (den > 0)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    return F.struct(F.when(ok, num).otherwise(zero).alias("num"), F.when(ok, den).otherwise(one).alias("den"))


def is_variable_rate(avg_num: Column, avg_den: Column, r_num: Column, r_den: Column) -> Column:
    return (avg_num == 0) | (avg_num != r_num) | (avg_den != r_den)


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor, by Euclid's steps folded over a fixed sequence; enough for any 64-bit pair."""
    zero = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    step = lambda s, _: F.struct(F.when(s["b"] == 0, s["a"]).otherwise(s["b"]).alias("a"), F.when(s["b"] == 0, F.lit(0).cast("long")).otherwise(F.try_mod(s["a"], s["b"])).alias("b"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(96)), zero, step, lambda s: s["a"])


def aspect_label(width: Column, height: Column) -> Column:
    g = gcd(width, height)
    return F.concat_ws(":", (width / g).cast("long"), (height / g).cast("long"))


def size_label(width: Column, height: Column) -> Column:
    return F.concat_ws("x", width, height)


def fade_factor(t: Column, start: Column, end: Column, fade_in: Column, fade_out: Column) -> Column:
    """Visibility of an event at a time: a ramp up, full, a ramp down."""
    span, at = F.greatest(end - start, F.lit(1)), t - start
    rising = F.greatest(F.lit(0.0), F.try_divide(at.cast("double"), fade_in))
    falling = F.greatest(F.lit(0.0), F.try_divide((span - at).cast("double"), fade_out))
    return F.when((fade_in > 0) & (at < fade_in), rising).when((fade_out > 0) & (at > span - fade_out), falling).otherwise(1.0)


def event_timing(duration: Column, time_ms: Column, frame: Column, fps: Column, num: Column, den: Column) -> Column:
    """Times, ticks and frames of an event around a source frame; 30 frames a second where the rate is unknown."""
    start = F.greatest(F.lit(0).cast("long"), time_ms - F.floor(duration / 2))
    rate = F.when(fps > 0, fps).otherwise(30.0)
    frames = F.greatest(F.rint(duration / 1000.0 * rate).cast("long"), F.lit(1).cast("long"))
    first = F.greatest(F.lit(0).cast("long"), frame - F.floor(frames / 2))
    return F.struct(
        start.alias("start_time_ms"), (start + duration).alias("end_time_ms"), ms_to_pts(start, num, den).alias("start_pts"),
        ms_to_pts(start + duration, num, den).alias("end_pts"), first.alias("start_frame"), (first + frames).alias("end_frame"), frames.alias("duration_frames"),
    )


def representative_time(start: Column, duration: Column, k: int, i: Column) -> Column:
    if k <= 1:
        return start + F.floor(duration / 2)
    return start + F.rint(i * duration / float(k - 1)).cast("long")


def even_picks(total: Column, count: int) -> Column:
    """Indices of ``count`` evenly spread items of ``total``, each once; all of them if there are no more."""
    spread = F.transform(F.sequence(F.lit(0), F.lit(max(count, 2) - 1)), lambda i: F.rint(i * (total - 1) / float(max(count - 1, 1))).cast("long"))
    every = F.when(total > 0, F.sequence(F.lit(0).cast("long"), total.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return F.when(total <= count, every).otherwise(F.array_distinct(spread))
