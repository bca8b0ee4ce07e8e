"""Deterministic per-row randomness.

Every random choice in the library (fold assignment, resampling, permutation,
row sampling) is a function of ``md5(seed:part:...:id)``.  Unlike ``rand()`` it
is replayable when a task is retried on another executor, it does not depend on
partitioning, and SQL engines compute the same digest, so the choice can be
checked outside Spark.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 15          # 60 bits: a non-negative signed bigint


def _as_col(c) -> Column:
    return c if isinstance(c, Column) else F.col(c)


def hash_key(seed, *parts) -> Column:
    """``md5('seed:part1:part2...')`` as a 32-char hex string.

    ``parts`` are column names or Columns; literals must be passed as ``F.lit``.
    """
    pieces = [F.lit(str(seed))] + [_as_col(p).cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces))


def hash_order(seed, *parts) -> Column:
    """First 60 bits of :func:`hash_key` as a non-negative bigint.

    Sorting by it equals sorting by the hex string except on a 60-bit prefix
    collision, which callers break by the full digest and the row id.
    """
    return F.conv(F.substring(hash_key(seed, *parts), 1, _HEX_DIGITS), 16, 10).cast("long")


def hash_rest(seed, *parts) -> Column:
    """The next 60 bits of :func:`hash_key` as a non-negative bigint: what breaks the ties of :func:`hash_order`, in 8 bytes."""
    return F.conv(F.substring(hash_key(seed, *parts), _HEX_DIGITS + 1, _HEX_DIGITS), 16, 10).cast("long")
