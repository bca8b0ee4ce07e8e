"""Digamma at positive integers as a Spark column expression.

psi(n) = H(n-1) - gamma.  Below ``_EXACT`` the harmonic sums are literals built
from that rule; above it the asymptotic series
ln n - 1/(2n) - 1/(12n^2) + 1/(120n^4) - 1/(252n^6) + 1/(240n^8) - 1/(132n^10)
is accurate to about 1e-14.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EULER_GAMMA = 0.5772156649015329
_EXACT = 10


def digamma_exact(n: int) -> float:
    return sum(1.0 / j for j in range(1, n)) - EULER_GAMMA


def digamma_int(n: Column) -> Column:
    x = n.cast("double")
    inv = F.lit(1.0) / x
    inv2 = inv * inv
    series = (F.log(x) - inv / 2 - inv2 / 12 + inv2 * inv2 / 120 - inv2 * inv2 * inv2 / 252
              + inv2 ** 4 / 240 - inv2 ** 5 / 132)
    expr = series
    for k in range(_EXACT - 1, 0, -1):
        expr = F.when(n == k, F.lit(digamma_exact(k))).otherwise(expr)
    return expr


def digamma_py(n: int) -> float:
    if n < _EXACT:
        return digamma_exact(n)
    x = float(n)
    return (math.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4) - 1 / (252 * x ** 6)
            + 1 / (240 * x ** 8) - 1 / (132 * x ** 10))
