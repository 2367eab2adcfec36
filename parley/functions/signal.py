"""Array expressions for signals and spectra: SCL-12, SCL-13, SCL-15, SCL-16, SCL-17, WIN-5.

A signal or a magnitude spectrum is an ``array<double>`` column; everything stays inside the
row (higher-order functions), so no explode and no shuffle is needed per frame.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

AMIN = 1e-10


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _sum(arr) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def positive(what: str, value: int) -> None:
    """FIL-6: an argument check."""
    if value <= 0:
        raise ValueError(f"the {what} has to be greater than 0, not {value}")


def frames(col, size: int) -> Column:
    """SCL-15: non-overlapping frames of ``size``; an incomplete tail is dropped."""
    a = _c(col)
    positive("frame size", size)
    n_full = F.floor(F.size(a) / size).cast("int")
    starts = F.when(n_full > 0, F.sequence(F.lit(0), n_full - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(a, i * size + 1, size))


def blocks(col, size: int) -> Column:
    """SCL-16: consecutive blocks of ``size``; the last, shorter block is kept."""
    a = _c(col)
    positive("block size", size)
    n_blk = F.ceil(F.size(a) / size).cast("int")
    starts = F.when(n_blk > 0, F.sequence(F.lit(0), n_blk - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(a, i * size + 1, size))


def channel(col, index: int, channels: int = 2) -> Column:
    """SCL-17: one channel of an interleaved multi-channel signal."""
    positive("number of channels", channels)
    if not 0 <= index < channels:
        raise ValueError(f"there is no channel {index} of {channels}")
    return F.filter(_c(col), lambda x, i: i % channels == index)


def interleave_channels(left, right) -> Column:
    """SCL-17 re-stack: two channels back to one interleaved signal; of an odd number of values the left one has
    the last."""
    both = F.flatten(F.zip_with(_c(left), _c(right), lambda a, b: F.array(a, b)))
    return F.slice(both, F.lit(1), F.size(_c(left)) + F.size(_c(right)))


def centroid(mag) -> Column:
    """SCL-12: energy-weighted mean bin index; null for an all-zero spectrum."""
    m = _c(mag)
    total = _sum(m)
    weighted = _sum(F.transform(m, lambda x, i: x * i))
    return F.when(total > 0, weighted / total)


def flatness(mag) -> Column:
    """SCL-13: geometric over arithmetic mean of the power spectrum (floored at 1e-10)."""
    p = F.transform(_c(mag), lambda x: F.greatest(x * x, F.lit(AMIN)))
    n = F.size(p)
    return F.when(n > 0, F.exp(_sum(F.transform(p, lambda x: F.log(x))) / n) / (_sum(p) / n))


def rolloff(mag, pct: float) -> Column:
    """WIN-5: the first bin at which the running sum reaches ``pct`` of the total."""
    m = _c(mag)
    total = _sum(m)
    init = F.struct(F.lit(0.0).cast("double").alias("cum"), F.lit(0).alias("i"),
                    F.lit(None).cast("int").alias("hit"))

    def step(acc, x):
        cum = acc["cum"] + x
        hit = F.when(acc["hit"].isNull() & (cum >= F.lit(pct) * total), acc["i"]).otherwise(acc["hit"])
        return F.struct(cum.alias("cum"), (acc["i"] + 1).alias("i"), hit.alias("hit"))

    return F.when(total > 0, F.aggregate(m, init, step)["hit"])
