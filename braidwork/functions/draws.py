"""Reproducible pseudo-random numbers.

``rand(seed)`` depends on how rows are laid out over partitions, so it changes
when a job is retried or repartitioned. Hash-based draws depend on the row's
own key only.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 13 hex digits are 52 bits, which a double holds exactly.
_DIGITS = 13


def hash_key(seed: int, *parts: Column) -> Column:
    """Hex digest of the seed and the row's key parts."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def uniform(seed: int, *parts: Column) -> Column:
    """A draw from the open interval (0, 1)."""
    bits = F.conv(F.substring(hash_key(seed, *parts), 1, _DIGITS), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(16**_DIGITS))


def gumbel(seed: int, *parts: Column) -> Column:
    """A standard Gumbel draw: the arg-max of ``logit + gumbel`` is a softmax sample."""
    return -F.log(-F.log(uniform(seed, *parts)))
