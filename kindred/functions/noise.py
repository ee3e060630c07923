"""Random numbers that depend on a row's key and a seed, never on its partition.

``rand()`` follows partition order, so a lost executor or another partitioning
would change results.  Hashing the key gives the same draw every time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def shuffle_key(seed: int | str, key: Column) -> Column:
    """Hex digest whose order is a seeded shuffle of the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def _unit(hex8: Column) -> Column:
    """Eight hex digits as a number strictly between 0 and 1."""
    return (F.conv(hex8, 16, 10).cast("double") + 0.5) / float(1 << 32)


def uniform(seed: int | str, key: Column) -> Column:
    return _unit(F.substring(shuffle_key(seed, key), 1, 8))


def uniform_int(low: Column, high: Column, seed: int | str, key: Column) -> Column:
    """Whole number in [low, high); ``low`` where the two are equal."""
    return F.floor(low + uniform(seed, key) * (high - low)).cast("long")


def gaussian(seed: int | str, key: Column) -> Column:
    """Standard normal draw (Box-Muller on two digests' worth of digits)."""
    digest = shuffle_key(seed, key)
    u = _unit(F.substring(digest, 1, 8))
    v = _unit(F.substring(digest, 9, 8))
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * v)
