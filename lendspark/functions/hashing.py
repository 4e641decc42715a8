"""Deterministic, partition-independent pseudo-randomness.

``rand()`` depends on partition layout and task retries; these helpers
depend only on the key and a seed, so a lost executor that recomputes a
partition produces the same draws.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 53
_SCALE = float(2 ** _BITS)


def hash_uniform(key: Column, seed: int, stream: int = 0) -> Column:
    """Uniform draw in [0, 1) keyed on ``key``."""
    h = F.xxhash64(key.cast("string"), F.lit(int(seed)), F.lit(int(stream)))
    return F.pmod(h, F.lit(2 ** _BITS)).cast("double") / F.lit(_SCALE)


def hash_normal(key: Column, seed: int, mean: float = 0.0, std: float = 1.0) -> Column:
    """Normal draw via Box–Muller on two independent uniforms."""
    u1 = hash_uniform(key, seed, 1)
    u2 = hash_uniform(key, seed, 2)
    # 1 - u1 lies in (0, 1], so the log is finite.
    z = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(mean) + F.lit(std) * z


def hash_fold(key: Column, seed: int, k: int) -> Column:
    """Fold id in [0, k) for cross-validation / splits."""
    return F.pmod(F.xxhash64(key.cast("string"), F.lit(int(seed)), F.lit(7)), F.lit(int(k))).cast("int")


def md5_bits(text: Column, digits: int = 15) -> Column:
    """The first ``digits`` hex digits (4 bits each, 15 at most) of md5(text) as
    a bigint: the one hash here that SQL engines share."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("bigint")
