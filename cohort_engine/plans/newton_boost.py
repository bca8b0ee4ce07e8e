"""Boosted trees of second order (E4): leaves and splits from gradients and curvatures.

Columns are cut at given points, or at their quantiles, into at most 256 bins, and a row keeps
one byte a column.  A level of a tree is one pass: tasks sum gradient and curvature of the
logistic loss by (open node, column, bin) into one vector per node, Spark adds the vectors, and
the driver takes the best split of every node by

    gain = 1/2 [G_l^2 / (H_l + lambda) + G_r^2 / (H_r + lambda) - G^2 / (H + lambda)] - gamma

Leaves weigh ``-G / (H + lambda)``; splits without gain are pruned from the bottom.  A row's
margin over the finished trees is kept beside its bytes and renewed every ``REFRESH`` trees.
NULL cells go the way that gains more, which each split learns.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.plans.multi_fit import vector_sums

BINS = 256               # the last one holds NULL
REFRESH = 10             # trees after which rows keep their margin
ROOT = 1                 # children of node k are 2k and 2k + 1


@dataclass
class Node:
    gain: float = 0.0
    weight: float = 0.0
    column: int = -1                     # -1: a leaf
    cut: int = 0                         # codes up to this one go left
    null_left: bool = True
    cover: float = 0.0


@dataclass
class BoostedTrees:
    columns: list[str]
    cuts: list[np.ndarray]               # inner cut points of each column; a value up to the k-th has code k
    rate: float
    base: float                          # margin before the first tree
    trees: list[dict[int, Node]] = field(default_factory=list)

    def codes(self, x: np.ndarray) -> np.ndarray:
        out = np.empty(x.shape, np.uint8)
        for j, cut in enumerate(self.cuts):
            out[:, j] = np.where(np.isnan(x[:, j]), BINS - 1, np.searchsorted(cut, x[:, j], side="left"))
        return out

    def leaves(self, codes: np.ndarray, tree: dict[int, Node]) -> np.ndarray:
        """The node each row ends in."""
        at = np.full(len(codes), ROOT)
        open_nodes = [ROOT]
        while open_nodes:
            k = open_nodes.pop()
            node = tree.get(k)
            if node is None or node.column < 0:
                continue
            rows = np.flatnonzero(at == k)
            code = codes[rows, node.column]
            left = np.where(code == BINS - 1, node.null_left, code <= node.cut)
            at[rows] = np.where(left, 2 * k, 2 * k + 1)
            open_nodes += [2 * k, 2 * k + 1]
        return at

    def margin(self, codes: np.ndarray, first: int = 0) -> np.ndarray:
        out = np.zeros(len(codes))
        for tree in self.trees[first:]:
            at = self.leaves(codes, tree)
            out += self.rate * np.array([tree[k].weight for k in range(1, max(tree) + 1) if k in tree])[np.searchsorted(sorted(tree), at)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.base + self.margin(self.codes(x)))))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``p1`` and ``prediction``."""
        @F.pandas_udf("double")
        def p1(*cells: pd.Series) -> pd.Series:
            return pd.Series(self.probability(np.column_stack([c.to_numpy(float) for c in cells])))
        return df.withColumn("p1", p1(*(F.col(c).cast("double") for c in self.columns))).withColumn("prediction", (F.col("p1") > 0.5).cast("double"))

    def table(self) -> list[tuple]:
        """``(tree, node, feature, cut, gain, weight, cover)`` of every node; feature NULL is a leaf."""
        return [(t, k, self.columns[n.column] if n.column >= 0 else None, float(self.cuts[n.column][n.cut]) if n.column >= 0 else None,
                 float(n.gain), float(n.weight), float(n.cover)) for t, tree in enumerate(self.trees) for k, n in sorted(tree.items())]


def quantile_cuts(df: DataFrame, cols: Sequence[str], bins: int = BINS - 1) -> list[np.ndarray]:
    from cohort_engine.functions.quantiles import cut_points
    return [np.array(c) for c in cut_points(df, list(cols), bins)]


def best_split(g: np.ndarray, h: np.ndarray, cuts: int, lam: float, gamma: float, least: float) -> tuple[float, int, bool]:
    """(gain, code, NULL goes left) of one column's bins; the first best."""
    whole_g, whole_h, null_g, null_h = g.sum(), h.sum(), g[-1], h[-1]
    found = (0.0, -1, True)
    left_g, left_h = g[:cuts].cumsum(), h[:cuts].cumsum()
    for null_left in (True, False) if null_h > 0 else (True,):
        lg, lh = (left_g + null_g, left_h + null_h) if null_left else (left_g, left_h)
        rg, rh = whole_g - lg, whole_h - lh
        gain = (lg ** 2 / (lh + lam) + rg ** 2 / (rh + lam) - whole_g ** 2 / (whole_h + lam)) / 2 - gamma
        gain = np.where((lh >= least) & (rh >= least), gain, -np.inf)
        if len(gain) and gain.max() > found[0] + 1e-12 * max(1.0, abs(found[0])):
            found = (float(gain.max()), int(gain.argmax()), null_left)
    return found


def fit_newton(df: DataFrame, cols: Sequence[str], label: str, trees: int = 100, depth: int = 6, rate: float = 0.3, lam: float = 1.0, gamma: float = 0.0,
               least: float = 1.0, base: float = 0.5, cuts: list[np.ndarray] | None = None, weight: str | None = None) -> BoostedTrees:
    """Boosted trees for a 0/1 label; ``least`` is the curvature a child must hold, ``base`` the probability to start from."""
    cols = list(cols)
    model = BoostedTrees(cols, cuts or quantile_cuts(df, cols), rate, float(np.log(base / (1 - base))))
    if any(len(c) > BINS - 2 for c in model.cuts):
        raise ValueError(f"at most {BINS - 2} cut points a column")

    def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            codes = model.codes(pdf[cols].to_numpy(float))
            yield pd.DataFrame({"codes": [c.tobytes() for c in codes], "y": pdf["_y"], "w": pdf["_w"], "margin": model.base})

    def renewed(first: int):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pdf.assign(margin=pdf["margin"] + model.margin(matrix(pdf), first)) if len(pdf) else pdf
        return run

    def matrix(pdf: pd.DataFrame) -> np.ndarray:
        return np.frombuffer(b"".join(pdf["codes"]), np.uint8).reshape(len(pdf["codes"]), len(cols))

    schema = "codes binary, y double, w double, margin double"
    source = df.select(*(F.col(c).cast("double").alias(c) for c in cols), F.col(label).cast("double").alias("_y"), (F.col(weight) if weight else F.lit(1)).cast("double").alias("_w"))
    rows = source.mapInPandas(coded, schema).persist(StorageLevel.MEMORY_AND_DISK)
    kept_from, caches = 0, [rows]
    for t in range(trees):
        if t - kept_from == REFRESH:
            rows = rows.mapInPandas(renewed(kept_from), schema).persist(StorageLevel.MEMORY_AND_DISK)
            caches.append(rows)
            kept_from = t
        tree: dict[int, Node] = {ROOT: Node()}
        open_nodes = [ROOT]
        for level in range(depth + 1):
            last = level == depth

            def histograms(pdf: pd.DataFrame, tree=tree, open_nodes=tuple(open_nodes), first=kept_from, last=last) -> dict[int, np.ndarray]:
                codes, y, w = matrix(pdf), pdf["y"].to_numpy(), pdf["w"].to_numpy()
                p = 1 / (1 + np.exp(-(pdf["margin"].to_numpy() + model.margin(codes, first))))
                g, h, at, out = w * (p - y), w * p * (1 - p), model.leaves(codes, tree), {}
                for k in open_nodes:
                    own = at == k
                    if not own.any():
                        continue
                    parts = [[g[own].sum(), h[own].sum(), w[own].sum()]]
                    if not last:
                        for j in range(len(cols)):
                            parts += [np.bincount(codes[own, j], v[own], BINS) for v in (g, h)]
                    out[k] = np.concatenate(parts)
                return out

            sums = vector_sums(rows, ["codes", "y", "w", "margin"], histograms)
            split: list[int] = []
            for k in open_nodes:
                v = sums.get(k)
                if v is None:
                    continue
                tree[k].weight, tree[k].cover = -v[0] / (v[1] + lam), v[2]
                if last:
                    continue
                hist = v[3:].reshape(len(cols), 2, BINS)
                found = [best_split(hist[j, 0], hist[j, 1], len(model.cuts[j]), lam, gamma, least) for j in range(len(cols))]
                j = int(np.argmax([f[0] for f in found]))
                if found[j][1] >= 0:
                    tree[k].gain, tree[k].column, tree[k].cut, tree[k].null_left = found[j][0], j, found[j][1], found[j][2]
                    tree[2 * k], tree[2 * k + 1] = Node(), Node()
                    split += [2 * k, 2 * k + 1]
            open_nodes = split
            if not open_nodes:
                break
        model.trees.append(tree)
    for c in caches:
        c.unpersist()
    return model
