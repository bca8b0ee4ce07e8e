"""The lasso for all strengths, and all folds, from one pass of sums.

The objective  1/(2n) |y - Xw - b|^2 + alpha |w|_1  depends on the rows through their number,
means and products alone.  One pass sums these per fold, as one vector each; the sums of the
rows outside a fold are the whole's less the fold's, so a fold costs no pass of its own.
Coordinate descent over the strengths, largest first and each from the last one's weights,
then works on the ``p x p`` products, which is what limits the number of features.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.plans.multi_fit import arrays, vector_sums

MAX_FEATURES = 2_000     # products of that many columns: 32 MB a fold
TOLERANCE = 1e-11        # largest change of a weight in a round, by the column's spread
MAX_ROUNDS = 20_000
ALL = -1                 # the fold that leaves nothing out
SELECTED = 1e-5          # fixed value: weights up to this size count as zero


def product_sums(rows: DataFrame, p: int) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per ``fold``: weight, sums and products of (x, y) about the whole table's means (``x`` array, ``y``, ``w``, ``fold``)."""
    if p > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")

    def joined(pdf: pd.DataFrame) -> np.ndarray:
        return np.column_stack([arrays(pdf["x"]), pdf["y"].to_numpy(float)])

    def means(pdf: pd.DataFrame) -> dict[int, np.ndarray]:
        z, w = joined(pdf), pdf["w"].to_numpy(float)
        return {0: np.append(w @ z, w.sum())}

    total = vector_sums(rows, ["x", "y", "w"], means).get(0, np.append(np.zeros(p + 1), 0.0))
    center = total[:-1] / max(total[-1], 1e-300)

    def products(pdf: pd.DataFrame) -> dict[int, np.ndarray]:
        z, w, fold = joined(pdf) - center, pdf["w"].to_numpy(float), pdf["fold"].to_numpy()
        out = {}
        for f in np.unique(fold):
            own = z[fold == f]
            weighted = own * w[fold == f, None]
            out[int(f)] = np.concatenate([[w[fold == f].sum()], weighted.sum(axis=0), (weighted.T @ own).ravel()])
        return out

    sums = vector_sums(rows, ["x", "y", "w", "fold"], products)
    return {f: (v[0], v[1:p + 2], v[p + 2:].reshape(p + 1, p + 1)) for f, v in sums.items()}


def descend(n: float, s: np.ndarray, g: np.ndarray, alphas: Sequence[float]) -> dict[float, np.ndarray]:
    """Weights for every strength from weight, sums and products of (x, y)."""
    p = len(s) - 1
    out: dict[float, np.ndarray] = {}
    w = np.zeros(p)
    if not n:
        return {a: w for a in alphas}
    cov = g / n - np.outer(s, s) / n ** 2
    c, xy, spread = cov[:p, :p], cov[:p, p], np.maximum(np.diag(cov)[:p], 0)
    for alpha in sorted(alphas, reverse=True):
        left = xy - c @ w                        # covariance of each column with the residual
        for _ in range(MAX_ROUNDS):
            most = 0.0
            for j in np.flatnonzero(spread > 1e-14):
                rho = left[j] + spread[j] * w[j]
                new = np.sign(rho) * max(abs(rho) - alpha, 0.0) / spread[j]
                if new != w[j]:
                    left -= c[:, j] * (new - w[j])
                    most = max(most, abs(new - w[j]) * np.sqrt(spread[j]))
                    w[j] = new
            if most <= TOLERANCE:
                break
        out[alpha] = w.copy()
    return out


def lasso_paths(rows: DataFrame, p: int, alphas: Sequence[float], folds: Sequence[int] = (ALL,)) -> dict[tuple[int, float], np.ndarray]:
    """Weights by (fold, strength); the rows of a fold are left out, ``ALL`` leaves out none.  ``rows`` is read twice."""
    sums = product_sums(rows, p)
    whole = [sum(part) for part in zip(*sums.values())] or [0.0, np.zeros(p + 1), np.zeros((p + 1, p + 1))]
    out = {}
    for fold in folds:
        parts = whole if fold == ALL or fold not in sums else [a - b for a, b in zip(whole, sums[fold])]
        out |= {(fold, a): w for a, w in descend(*parts, alphas).items()}
    return out


def lasso_path(df: DataFrame, cols: Sequence[str], label: str, alphas: Sequence[float], fold: str | None = None, weight: str | None = None,
               folds: Sequence[int] = ()) -> DataFrame:
    """``(fold, alpha, feature, coef)`` of every strength, for all rows (fold -1) and with each of ``folds`` left out."""
    rows = df.select(F.array(*(F.col(c).cast("double") for c in cols)).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(weight) if weight else F.lit(1)).cast("double").alias("w"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    found = lasso_paths(rows, len(cols), alphas, [ALL, *folds])
    return df.sparkSession.createDataFrame([(f, float(a), c, float(v)) for (f, a), w in found.items() for c, v in zip(cols, w)],
                                           "fold int, alpha double, feature string, coef double")


def optimality(df: DataFrame, cols: Sequence[str], label: str, path: DataFrame, fold: str) -> DataFrame:
    """``(fold, alpha, n_rows, n_selected, worst)``: by how much the conditions of the minimum are missed, summed again in the JVM.

    The residual's covariance with a column is alpha times the sign of its weight, or at most alpha where that is zero."""
    weights: dict[tuple, dict[str, float]] = {}
    for r in path.collect():                     # features x strengths x folds
        weights.setdefault((r["fold"], r["alpha"]), {})[r["feature"]] = r["coef"]
    parts = None
    for (f, alpha), w in sorted(weights.items()):
        own = df.where(F.col(fold) != f) if f != ALL else df
        fit = sum((F.col(c) * v for c, v in w.items()), F.lit(0.0))
        residual = F.col(label).cast("double") - fit
        miss = [F.abs(cov - alpha * np.sign(w[c])) if w[c] else F.greatest(F.lit(0.0), F.abs(cov) - alpha) for c in cols for cov in [F.covar_pop(F.col(c), residual)]]
        one = own.agg(F.count(F.lit(1)).alias("n_rows"), F.greatest(F.lit(0.0), *miss).alias("worst")).select(
            F.lit(f).alias("fold"), F.lit(alpha).alias("alpha"), "n_rows", F.lit(sum(abs(v) > SELECTED for v in w.values())).alias("n_selected"), "worst")
        parts = one if parts is None else parts.unionByName(one)
    return parts
