"""Colours of the Piper fields."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def rgb_hex(r: Column, g: Column, b: Column) -> Column:
    def two(c: Column) -> Column:
        return F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")

    return F.concat(F.lit("#"), two(r), two(g), two(b))


def outside_turn(sixth: Column) -> Column:
    return F.when((sixth < 0) | (sixth >= 6), F.lit(1.0)).otherwise(F.lit(0.0))


def hsv_channel(sixth: Column, outside: Column, chroma: Column, v: Column, channel: str) -> Column:
    """One channel in 0..1, from the hue in sixths of a turn.

    A channel falls from v by the chroma times the distance of the hue from the channel's
    own range, which is cut to 0..1; one expression serves all six sectors. Outside one
    turn (``outside`` is 1) only v - chroma is left.
    """
    k = F.pmod(sixth + F.lit({"r": 5.0, "g": 3.0, "b": 1.0}[channel]), F.lit(6.0))
    return v - chroma * F.greatest(outside, F.least(k, F.lit(4.0) - k, F.lit(1.0)))


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """struct(r, g, b) in 0..1; the hue is in radians."""
    sixth = h / F.lit(math.pi / 3)
    return F.struct(*[hsv_channel(sixth, outside_turn(sixth), v * s, v, c).alias(c) for c in "rgb"])
