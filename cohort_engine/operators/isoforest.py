"""Isolation-forest feature screening (O3), one forest per single column.

Fixed values of the reference's forest: 100 trees, sub-samples of
min(256, n) rows drawn without replacement, depth limit ceil(log2(psi)), a cell
is an outlier when its anomaly score 2^(-E[h] / c(psi)) exceeds 0.5, and a feature
is flagged when more than ``threshold`` of its cells are outliers.

Spark layout:

1. per feature, about ``2 x trees x psi`` non-NULL cells are drawn by hash and dealt to
   the trees (to several trees each where a column has fewer cells than that), and every
   tree takes the ``psi`` of its cells first in its own hash order; ``psi`` counts the
   feature's own non-NULL cells, so NULLs neither fill a sample nor its normalisation;
2. ``applyInPandas`` grows each (feature, tree) on at most ``psi`` values; in one
   dimension a tree is a partition of the line, returned as leaf intervals with
   their path length ``depth + c(leaf size)``;
3. the 100 trees of a feature (at most 100 x 256 leaves, a bounded group) are
   merged in ``applyInPandas`` into the maximal value ranges whose mean path
   length makes a cell an outlier; only those ranges reach the driver, and every
   row is scored against them with a vectorised ``searchsorted`` in
   ``mapInPandas`` -- only per-partition outlier counts leave the tasks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.operators.stats import to_long

N_TREES = 100
MAX_SAMPLES = 256
SCORE_CUTOFF = 0.5
EULER_GAMMA = 0.5772156649015329


def average_path_length(n: np.ndarray | float) -> np.ndarray:
    """c(n): mean path length of an unsuccessful search in a binary search tree."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def grow_intervals(values: np.ndarray, rng: np.random.Generator, max_depth: int) -> list[tuple]:
    """Leaves of one isolation tree on 1-D values: (upper bound, path length).

    Leaves are returned in order along the line; a leaf covers values up to and
    including its upper bound (the last one to +inf).  ``x <= threshold`` goes left.
    """
    leaves: list[tuple] = []

    def grow(vals, depth, upper):
        lo, hi = vals.min(), vals.max()
        if depth >= max_depth or len(vals) <= 1 or lo == hi:
            leaves.append((upper, depth + float(average_path_length(len(vals)))))
            return
        thr = rng.uniform(lo, hi)
        if thr == hi:
            thr = lo
        grow(vals[vals <= thr], depth + 1, thr)
        grow(vals[vals > thr], depth + 1, upper)

    grow(np.asarray(values, dtype=float), 0, np.inf)
    return leaves


def _tree_cells(base: DataFrame, cols: Sequence[str], id_col: str, sizes: dict[str, int], trees: int, seed: int) -> DataFrame:
    """(feature, tree, value): every tree's sample of its feature's non-NULL cells."""
    wanted = [(f, min(1.0, 2.0 * trees * min(MAX_SAMPLES, n) / n), min(trees, math.ceil(2 * trees * min(MAX_SAMPLES, n) / n)), min(MAX_SAMPLES, n))
              for f, n in sizes.items() if n]
    plan = base.sparkSession.createDataFrame(wanted, "feature string, rate double, copies int, psi int")
    cells = to_long(base, cols, keys=[id_col]).join(F.broadcast(plan), "feature")            # one row a column
    hashed = F.xxhash64(F.lit(seed), F.lit("pool"), F.col("feature"), F.col(id_col))
    pool = cells.where((hashed.cast("double") + 2.0 ** 63) / 2.0 ** 64 < F.col("rate"))
    first = F.pmod(F.xxhash64(F.lit(seed), F.lit("tree"), F.col("feature"), F.col(id_col)), F.lit(trees))
    dealt = (pool.withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
             .withColumn("tree", ((first + F.col("__k")) % trees).cast("int"))
             .withColumn("__h", F.xxhash64(F.lit(seed), F.col("tree"), F.col("feature"), F.col(id_col))))
    # about 2 x psi rows for every (feature, tree), whatever the column's length
    order = Window.partitionBy("feature", "tree").orderBy("__h", id_col)
    return dealt.withColumn("__r", F.row_number().over(order)).where("__r <= psi").select("feature", "tree", "value")


def isolation_report(df: DataFrame, cols: Sequence[str], threshold: float = 0.05, id_col: str = "patient_id",
                     trees: int = N_TREES, seed: int = 42) -> DataFrame:
    """O3 report ``(feature, outlier_share, flagged)``; NULL cells are not outliers."""
    spark = df.sparkSession
    cols = list(cols)
    if id_col not in df.columns:
        df = df.withColumn(id_col, F.monotonically_increasing_id())
    base = df.select(id_col, *[F.col(c).cast("double").alias(c) for c in cols]).persist()
    n = base.count()
    sizes = {c: 0 for c in cols} | {r["feature"]: r["n"] for r in to_long(base, cols).groupBy("feature").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    long = _tree_cells(base, cols, id_col, sizes, trees, seed)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        f, t = pdf["feature"].iloc[0], int(pdf["tree"].iloc[0])
        fidx = cols.index(f)
        rng = np.random.default_rng([seed, fidx, t])
        psi = min(MAX_SAMPLES, sizes[f])
        leaves = grow_intervals(np.sort(pdf["value"].to_numpy()), rng, int(math.ceil(math.log2(max(psi, 2)))))
        return pd.DataFrame({"feature": f, "tree": t, "upper": [u for u, _ in leaves],
                             "plen": [h for _, h in leaves]})

    leaves = long.groupBy("feature", "tree").applyInPandas(
        grow, "feature string, tree int, upper double, plen double")
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        """All trees of one feature (at most trees x psi leaves) -> the maximal
        intervals (lo, hi] where the mean path length makes a cell an outlier."""
        f = pdf["feature"].iloc[0]
        ups = pdf["upper"].to_numpy()
        cuts = np.unique(ups[np.isfinite(ups)])
        probe = np.append(cuts, np.inf)
        total = np.zeros(len(probe))
        n_trees = 0
        for _, g in pdf.groupby("tree"):
            g = g.sort_values("upper")
            total += g["plen"].to_numpy()[np.searchsorted(g["upper"].to_numpy(), probe, side="left")]
            n_trees += 1
        c_psi = float(average_path_length(min(MAX_SAMPLES, sizes[f])))
        outl = 2.0 ** (-(total / n_trees) / c_psi) > SCORE_CUTOFF if c_psi else np.zeros(len(probe), bool)
        lows = np.concatenate([[-np.inf], cuts])          # step i covers (lows[i], probe[i]]
        out, start = [], None
        for i, o in enumerate(outl):
            if o and start is None:
                start = lows[i]
            if not o and start is not None:
                out.append((start, lows[i]))
                start = None
        if start is not None:
            out.append((start, np.inf))
        return pd.DataFrame({"feature": f, "lo": [a for a, _ in out], "hi": [b for _, b in out]},
                            columns=["feature", "lo", "hi"])

    intervals = leaves.groupBy("feature").applyInPandas(merge, "feature string, lo double, hi double").collect()
    steps: dict[str, tuple] = {f: ([], []) for f in cols}
    for r in intervals:                                  # merged outlier ranges only
        steps[r["feature"]][0].append(r["lo"])
        steps[r["feature"]][1].append(r["hi"])
    steps = {f: (np.array(lo), np.array(hi)) for f, (lo, hi) in steps.items()}

    out = _outlier_counts(base, cols, steps)
    share = out.groupBy("feature").agg((F.sum("outliers") / F.lit(float(n))).alias("outlier_share"))
    got = {r["feature"]: r["outlier_share"] for r in share.collect()}   # one row per column
    base.unpersist()
    rows = [(c, float(got.get(c) or 0.0), bool((got.get(c) or 0.0) > threshold)) for c in cols]
    return spark.createDataFrame(rows, "feature string, outlier_share double, flagged boolean")


def _outlier_counts(base: DataFrame, feats: list[str], steps: dict) -> DataFrame:
    """(feature, outliers) per partition; the ranges of a feature are at most its trees' leaves."""
    bc = base.sparkSession.sparkContext.broadcast(steps)

    def score(batches):
        st = bc.value
        acc = {f: 0 for f in feats}
        for b in batches:
            for f in feats:
                lo, hi = st[f]
                if len(lo) == 0:
                    continue
                x = b[f].to_numpy(dtype=float)
                x = x[~np.isnan(x)]
                i = np.searchsorted(hi, x, side="left")          # first range whose hi >= x
                inside = i < len(hi)
                acc[f] += int(np.sum(x[inside] > lo[i[inside]]))
        yield pd.DataFrame({"feature": feats, "outliers": [acc[f] for f in feats]})

    return base.select(*feats).mapInPandas(score, "feature string, outliers long")
