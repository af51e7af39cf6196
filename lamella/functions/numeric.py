"""Coercions, ratios, deltas and pixel sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: pixel size (micrometres) assumed when a file states none.
FALLBACK_MPP = 0.5


def to_number(c: Column) -> Column:
    """Number of a text, NULL for blank or bad text."""
    return F.trim(c.cast("string")).try_cast("double")


def to_flag(c: Column) -> Column:
    """True, False or NULL from text or boolean."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text == "true", True).when(text == "false", False)


def native_mpp(text: Column) -> Column:
    value = to_number(text)
    return F.when(value > 0, value)


def mpp_is_fallback(source: Column) -> Column:
    """True when the source says the header had no pixel size, False for any other source."""
    return F.when(source.endswith("_no_mpp"), True).when(source != "", False)


def tiling_mpp(native: Column, fallback: Column) -> Column:
    return F.when(fallback, F.lit(FALLBACK_MPP)).otherwise(native)


def finite(c: Column) -> Column:
    """NULL for NaN and infinities."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def percentage(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent, capped at 100, 0 when the whole is 0."""
    return F.coalesce(F.round(F.least(part, whole) / F.nullif(whole, F.lit(0)) * 100, digits), F.lit(0.0))


def delta(variant: Column, base: Column) -> Column:
    return F.round(variant - base, 6)


def delta_band(c: Column) -> Column:
    size = F.abs(c)
    return (F.when(size < 0.001, "negligible").when(size < 0.01, "small")
            .when(size.isNotNull() & ~F.isnan(size), "large"))


def ci_half_widths(mean: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    zero = F.lit(0.0)
    m, l, h = (F.coalesce(c, zero) for c in (mean, lo, hi))
    return F.greatest(zero, m - l), F.greatest(zero, h - m)


def portable_hash(*keys: Column, seed: int = 0) -> Column:
    """A multiplicative hash in [0, 2**32) of whole-number or text keys that plain SQL can repeat.

    A text counts with the first eight hex digits of its MD5, a negative number with its remainder modulo 2**32.

    Values stay below 2**32 and the multipliers are small enough that no product
    leaves the range of a BIGINT. One step alone maps consecutive keys to an
    arithmetic progression; the shifted second step breaks that up.
    """
    h = F.lit(seed % 4294967296).cast("bigint")
    for key in keys:
        whole = F.coalesce(key.try_cast("bigint"),
                           F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"))
        h = ((h + F.pmod(whole, F.lit(4294967296))) * 747796405) % 4294967296
        h = ((h + F.floor(h / 65536).cast("bigint")) * 1540483477) % 4294967296
    return h
