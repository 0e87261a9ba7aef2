"""Hash-keyed splits and draws: the same key gives the same value in any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash32(key: Column) -> Column:
    return F.conv(F.substring(F.sha2(F.encode(key, "UTF-8"), 256), 1, 8), 16, 10).cast("double")


def hash_split(key: Column, ratios=(0.9, 0.05, 0.05)) -> Column:
    u = hash32(key.cast("string")) / 4294967295.0
    return F.when(u < ratios[0], "train").when(u < ratios[0] + ratios[1], "val").otherwise("test")


def keyed_u(seed: int, index: Column, *stage: str) -> Column:
    return hash32(F.concat_ws(":", F.lit(str(seed)), index.cast("string"), *map(F.lit, stage))) / 4294967296.0


def sample_dist(dist: str, u: Column, **p) -> Column:
    """Inverse distribution functions; normal takes a second draw u2."""
    if dist == "constant":
        return F.lit(float(p["value"]))
    if dist == "uniform":
        return p["low"] + u * (p["high"] - p["low"])
    if dist == "loguniform":
        return F.exp(F.log(F.lit(float(p["low"]))) + u * (F.log(F.lit(float(p["high"]))) - F.log(F.lit(float(p["low"])))))
    if dist == "uniform_int":
        return (p["low"] + F.floor(u * (p["high"] - p["low"] + 1))).cast("long")
    if dist == "triangular":
        a, m, b = p["low"], p["mode"], p["high"]
        cut = (m - a) / (b - a)
        return F.when(u < cut, a + F.sqrt(u * (b - a) * (m - a))).otherwise(b - F.sqrt((1 - u) * (b - a) * (b - m)))
    if dist == "normal":
        return p["mean"] + p["std"] * F.sqrt(-2 * F.log(1 - u)) * F.cos(2 * 3.141592653589793 * p["u2"])
    raise ValueError(dist)


def mod_split(i: Column, n: int = 10) -> Column:
    return F.when(i % n == n - 1, "test").when(i % n == n - 2, "val").otherwise("train")


def knuth_split(i: Column, frac: float) -> Column:
    return F.when(F.pmod(i * F.lit(2654435761), F.lit(4294967296)) / 4294967296.0 < frac, "val").otherwise("train")
