"""Recursive feature elimination whose rows are packed once and whose fits start from the last one.

A pass over the cohort packs its rows into matrices, one for each Arrow batch, and keeps those;
the fits of all rounds read them.  A Newton step is one job: tasks fold their matrices into one
vector (loss, gradient, curvature), Spark sums the vectors, and the driver, which holds one
coefficient for each feature, takes the step.  When features go, the curvature at the last minimum
says where the next one lies, so a round takes a pass or two whatever the number of rows.

The objective is that of ``multi_fit``: the summed logistic loss plus ``|w|^2 / (2 C)``, with a
free intercept.  It is convex, so the ranking does not depend on the path to the minimum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.plans.multi_fit import MAX_STEPS, vector_sums

MAX_FEATURES = 128       # a step's curvature has the square of that many numbers
TOLERANCE = 1e-10        # of a step's gain in the objective, by the rows' total weight; that step is still taken
DIGITS = 6               # significant ones in which weights are compared: equal ones go by name


def pack(df: DataFrame, cols: Sequence[str], label: str, weight: str | None) -> DataFrame:
    """``(m, low, high, total, w0, w1)``: rows as matrices with a line for each feature, the label and the weight, and a
    matrix's least and greatest values, weighted sums and weight by class.  Rows of weight 0 take no part."""
    p = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], dtype=float)
            if not np.isfinite(m).all():
                raise ValueError("features, labels and weights must be finite numbers, not NULL")
            if (m[p + 1] < 0).any():
                raise ValueError("weights must not be negative")
            if not m[p + 1].all():
                m = np.ascontiguousarray(m[:, m[p + 1] > 0])
            if not m.shape[1]:
                continue
            x, y, w = m[:p], m[p], m[p + 1]
            if not np.isin(y, (0.0, 1.0)).all():
                raise ValueError("labels must be 0 or 1")
            floats = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([m.tobytes()], pa.binary()), *(pa.array([v], floats) for v in (x.min(axis=1), x.max(axis=1), x @ w)),
                 *(pa.array([float(w[y == k].sum())]) for k in (0, 1))], ["m", "low", "high", "total", "w0", "w1"])

    rows = df.select(*(F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)), F.col(label).cast("double").alias("y"),
                     (F.col(weight) if weight else F.lit(1)).cast("double").alias("w"))
    return rows.mapInArrow(run, "m binary, low array<double>, high array<double>, total array<double>, w0 double, w1 double")


def packed_sums(p: int, kept: np.ndarray, center: np.ndarray, beta: np.ndarray) -> Callable[[dict], dict[int, np.ndarray]]:
    """Loss, gradient and curvature (without the penalty) at coefficients of the ``kept`` features about ``center`` (intercept last)."""
    def f(columns: dict) -> dict[int, np.ndarray]:
        out = np.zeros(1 + len(beta) + len(beta) ** 2)
        for block in columns["m"]:
            m = np.frombuffer(block).reshape(p + 2, -1)
            z, y, w = np.ones((len(beta), m.shape[1])), m[p], m[p + 1]
            np.subtract(m[kept], center[kept, None], out=z[:-1])
            margin = beta @ z
            e = np.exp(-np.abs(margin))
            prob = np.where(margin > 0, 1.0, e) / (1 + e)
            loss = w @ (np.log1p(e) + np.maximum(margin, 0) - y * margin)
            out += np.concatenate([[loss], z @ (w * (prob - y)), ((z * (w * prob * (1 - prob))) @ z.T).ravel()])
        return {0: out}
    return f


def solve(curve: np.ndarray, grad: np.ndarray) -> np.ndarray:
    """``curve^-1 grad``, the features brought to one scale first."""
    scale = 1 / np.sqrt(np.maximum(np.diag(curve), 1e-300))
    return scale * np.linalg.lstsq(curve * np.outer(scale, scale), scale * grad, rcond=None)[0]


def minimum(rows: DataFrame, p: int, kept: np.ndarray, center: np.ndarray, n: float, reg_c: float, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (intercept last) at the minimum over the ``kept`` features, and the curvature there."""
    ridge = np.append(np.full(len(kept), 1 / reg_c), 0.0)
    beta = at = start
    best, t, slope, step = np.inf, 1.0, 0.0, np.zeros_like(start)
    for _ in range(MAX_STEPS):
        sums = vector_sums(rows, ["m"], packed_sums(p, kept, center, beta))[0]
        size = len(beta)
        value = sums[0] + (ridge * beta ** 2).sum() / 2
        if value > best + 1e-4 * t * slope + 1e-9 * abs(value) and t > 1e-6:      # too far: half the step
            t /= 2
            beta = at - t * step
            continue
        grad, curve = sums[1:1 + size] + ridge * beta, sums[1 + size:].reshape(size, size) + np.diag(ridge + 1e-12 * n)
        step = solve(curve, grad)
        gain = float(grad @ step)
        at, beta, best, t, slope = beta, beta - step, value, 1.0, -gain
        if gain <= TOLERANCE * n:
            break
    return beta, curve


def eliminate(df: DataFrame, cols: Sequence[str], label: str, min_k: int, step: int, reg_c: float, weight: str | None) -> list[str]:
    """Features in the order in which elimination leaves them, the last survivors first.  ``df`` is read once."""
    cols, p = list(cols), len(cols)
    if p > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features")
    rows = pack(df, cols, label, weight).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        facts = rows.agg(F.coalesce(F.sum("w0"), F.lit(0.0)), F.coalesce(F.sum("w1"), F.lit(0.0)),
                         *(a(F.get(v, F.lit(i))) for a, v in ((F.min, "low"), (F.max, "high"), (F.sum, "total")) for i in range(p))).first()
        w0, w1, n = facts[0], facts[1], facts[0] + facts[1]
        if not n:
            raise ValueError("no rows with a weight to rank features by")
        low, high, total = np.array(facts[2:]).reshape(3, p)
        center = total / n
        # a constant feature has weight 0, and so has each one where all rows are of one class
        moving = low < high if w0 and w1 else np.zeros(p, bool)
        kept, beta = np.flatnonzero(moving), np.zeros(int(moving.sum()) + 1)
        remaining, eliminated = list(range(p)), []
        while len(remaining) > min_k:
            size = np.zeros(p)
            if len(kept):
                beta, curve = minimum(rows, p, kept, center, n, reg_c, beta)
                size[kept] = np.abs(beta[:-1])
            drop_n = min(step, len(remaining) - min_k)
            gone = sorted(remaining, key=lambda i: (float(f"{size[i]:.{DIGITS}g}"), cols[i]))[:drop_n]
            eliminated.extend(gone)
            remaining = [i for i in remaining if i not in gone]
            out = np.append(np.isin(kept, gone), False)
            if out.any():                # the last minimum's curvature tells where the others move
                beta = beta[~out] + solve(curve[np.ix_(~out, ~out)], curve[np.ix_(~out, out)] @ beta[out])
                kept = kept[~out[:-1]]
    finally:
        rows.unpersist()
    return [cols[i] for i in remaining + eliminated[::-1]]
