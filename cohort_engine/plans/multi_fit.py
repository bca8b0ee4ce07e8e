"""Logistic regressions of many candidates, all in one pass over the rows a step.

Every candidate has a regularisation strength, a number of leading features and a weight
column (which rows it learns from, and how often).  A Newton step of all candidates is one
job: tasks fold their rows into one vector per candidate (loss, gradient, curvature), Spark
sums the vectors, and the driver, which holds one coefficient vector per candidate, takes the
steps.  Candidates that have converged leave the pass.  Rows are read as they lie: a fold is a
weight of 0, a row drawn three times a weight of 3, so nothing is copied, sliced or shuffled.

The objective is that of the reference's solver: the summed logistic loss plus
``|w|^2 / (2 C)``, with a free intercept.  It is convex, so the fit does not depend on the path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_FEATURES = 512       # of one candidate: its curvature has the square of that many numbers
TOLERANCE = 1e-8         # of the largest gradient entry, by the rows' total weight
MAX_STEPS = 60


@dataclass(frozen=True)
class Candidate:
    c: float                 # inverse regularisation strength
    k: int                   # leading features
    group: int = 0           # place of its weight in the weight array


@dataclass
class Fit:
    candidate: Candidate
    weights: np.ndarray
    intercept: float
    total: float             # weight of its rows
    steps: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        return x[:, :self.candidate.k] @ self.weights + self.intercept


def columns_of(batch: pa.RecordBatch) -> dict[str, pd.Series | np.ndarray]:
    """The columns by name; an array column is a matrix over the batch's own memory, no object a row."""
    return {name: c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) if pa.types.is_list(c.type) else c.to_pandas()
            for name, c in zip(batch.schema.names, batch.columns)}


def vector_sums(rows: DataFrame, columns: Sequence[str], f: Callable[[dict[str, pd.Series | np.ndarray]], dict[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """For each key the sum over all batches of the vector ``f`` makes of a batch's columns; a task passes one vector a key on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                for key, v in f(columns_of(batch)).items():
                    total[key] = total[key] + v if key in total else v
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.astype(float) for v in total.values()], pa.list_(pa.float64()))], ["key", "v"])

    parts = rows.select(*columns).mapInArrow(run, "key int, v array<double>").select("key", array_to_vector("v").alias("v"))
    return {r["key"]: r["v"].toArray() for r in parts.groupBy("key").agg(Summarizer.sum(F.col("v")).alias("v")).collect()}


def arrays(column: pd.Series | np.ndarray) -> np.ndarray:
    return column if isinstance(column, np.ndarray) else np.stack(column.to_numpy())


def logistic_sums(params: dict[int, tuple[Candidate, np.ndarray]]) -> Callable[[pd.DataFrame], dict[int, np.ndarray]]:
    """Per candidate: total weight, loss, gradient and curvature (without the penalty) at its coefficients (intercept last)."""
    def f(pdf: pd.DataFrame) -> dict[int, np.ndarray]:
        x, w, y = arrays(pdf["x"]), arrays(pdf["w"]), pdf["label"].to_numpy(float)
        out = {}
        for key, (cand, beta) in params.items():
            own = w[:, cand.group]
            at = own > 0
            z = np.concatenate([x[at, :cand.k], np.ones((int(at.sum()), 1))], axis=1)
            margin, wt = z @ beta, own[at]
            p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
            loss = (wt * (np.logaddexp(0, margin) - y[at] * margin)).sum()
            curve = (z * (wt * p * (1 - p))[:, None]).T @ z
            out[key] = np.concatenate([[wt.sum(), loss], z.T @ (wt * (p - y[at])), curve.ravel()])
        return out
    return f


def multi_fit_lr(rows: DataFrame, candidates: Sequence[Candidate], tolerance: float = TOLERANCE) -> list[Fit]:
    """Fits of all candidates on ``rows`` (``label``, ``x`` array<double>, ``w`` array<double>, one weight a group).

    ``rows`` is read once a step; persist it.  A candidate without rows of both classes gets zero weights."""
    if any(c.k > MAX_FEATURES for c in candidates):
        raise ValueError(f"a candidate may have {MAX_FEATURES} features at most")
    beta = [np.zeros(c.k + 1) for c in candidates]
    state: list[dict] = [{"f": np.inf, "t": 1.0, "from": b, "step": np.zeros_like(b), "slope": 0.0, "n": 0.0, "steps": 0} for b in beta]
    active = set(range(len(candidates)))
    for _ in range(MAX_STEPS):
        if not active:
            break
        sums = vector_sums(rows, ["label", "x", "w"], logistic_sums({i: (candidates[i], beta[i]) for i in active}))
        for i in sorted(active):
            s, cand, size = state[i], candidates[i], len(beta[i])
            if i not in sums or not sums[i][0]:
                active.discard(i)
                continue
            n, loss, grad, curve = sums[i][0], sums[i][1], sums[i][2:2 + size], sums[i][2 + size:].reshape(size, size)
            ridge = np.append(np.full(cand.k, 1 / cand.c), 0.0)
            f, grad = loss + (ridge * beta[i] ** 2).sum() / 2, grad + ridge * beta[i]
            s["n"], s["steps"] = n, s["steps"] + 1
            if f > s["f"] + 1e-4 * s["t"] * s["slope"] + 1e-9 * abs(f) and s["t"] > 1e-6:      # too far: half the step
                s["t"] /= 2
                beta[i] = s["from"] - s["t"] * s["step"]
                continue
            if np.abs(grad).max() <= tolerance * n:
                active.discard(i)
                continue
            step = np.linalg.lstsq(curve + np.diag(ridge + 1e-12 * n), grad, rcond=None)[0]
            s |= {"f": f, "from": beta[i], "step": step, "t": 1.0, "slope": -float(grad @ step)}
            beta[i] = beta[i] - step
    return [Fit(c, b[:-1], float(b[-1]), state[i]["n"], state[i]["steps"]) for i, (c, b) in enumerate(zip(candidates, beta))]


def fit_counts(rows: DataFrame, fits: Sequence[Fit]) -> dict[int, dict[tuple[float, float], int]]:
    """Per fit the numbers of rows by (label, predicted class), from one pass."""
    def f(pdf: pd.DataFrame) -> dict[int, np.ndarray]:
        x, y = arrays(pdf["x"]), pdf["label"].to_numpy(int)
        return {i: np.bincount(2 * y + (fit.margin(x) > 0), minlength=4).astype(float) for i, fit in enumerate(fits)}

    counts = vector_sums(rows, ["label", "x"], f)
    return {i: {(float(k // 2), float(k % 2)): int(n) for k, n in enumerate(counts.get(i, np.zeros(4))) if n} for i in range(len(fits))}


def fit_table(rows: DataFrame, fits: Sequence[Fit]) -> DataFrame:
    """``(candidate, c, k, fold, n_rows, worst)``: each fit's largest gradient entry by its rows' weight, summed again in the JVM.

    The gradient is written as plain column expressions, apart from the solver's code."""
    parts = None
    for i, fit in enumerate(fits):
        weight, b = F.col("w")[fit.candidate.group], [float(v) for v in fit.weights]
        margin = sum((F.col("x")[j] * v for j, v in enumerate(b)), F.lit(fit.intercept))
        miss = weight * (1 / (1 + F.exp(-margin)) - F.col("label"))
        sums = [F.abs(F.sum(miss * F.col("x")[j]) + v / fit.candidate.c) for j, v in enumerate(b)] + [F.abs(F.sum(miss))]
        one = rows.agg(F.sum(weight).cast("long").alias("n_rows"), F.greatest(*sums).alias("gradient")).select(
            F.lit(i).alias("candidate"), F.lit(float(fit.candidate.c)).alias("c"), F.lit(fit.candidate.k).alias("k"), F.lit(fit.candidate.group).alias("fold"),
            "n_rows", (F.col("gradient") / F.col("n_rows")).alias("worst"))
        parts = one if parts is None else parts.unionByName(one)
    return parts
