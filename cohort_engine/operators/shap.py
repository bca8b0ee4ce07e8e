"""SHAP attributions as DataFrames.

* Tree models (forest, tree, boosted trees): path-dependent TreeSHAP (Lundberg,
  Erion & Lee 2018) over the node tables Spark writes when a model is saved.  The
  tables (bounded by the model size) are broadcast; rows are explained in
  ``mapInPandas``, so any number of rows can be explained.  Forest / tree values
  are P(class 1); boosted trees are in margin units.
* Linear models (logistic regression, linear SVM): exact closed form on the
  margin, ``phi_i = w_i (x_i - mean_i)`` with means over the background rows.
* Other models (RBF SVM): Shapley values estimated by sampled feature
  permutations against background rows (Strumbelj & Kononenko 2014); all hybrid
  points are scored by one ``transform``.

Every result is long: ``(row id, feature, value, phi, base, fx)``; ``base + sum(phi)
= fx`` row by row (exactly for the first two, in expectation for the third).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.functions.hashing import hash_order
from cohort_engine.operators.explain import sample_rows
from cohort_engine.operators.stats import moments
from cohort_engine.session import ensure_checkpoint_dir

SHAP_ROWS = 100               # fixed value: rows explained / background rows in the reference
PERMUTATION_SAMPLES = 32


# ---------------------------------------------------------------------------
# tree tables
# ---------------------------------------------------------------------------

def tree_tables(fitted) -> tuple[list[dict], np.ndarray, str]:
    """Per tree numpy arrays (left, right, feature, threshold, value, cover), tree
    weights and the output kind ('probability' | 'margin')."""
    spark = _spark()
    algo = fitted.algorithm
    path = f"{ensure_checkpoint_dir(spark)}/shap-model-{uuid.uuid4().hex}"
    fitted.model.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    if "treeID" not in nodes.columns:
        nodes = nodes.select(F.lit(0).alias("treeID"), F.struct("*").alias("nodeData"))
    rows = nodes.select("treeID", "nodeData.*").collect()          # bounded by the model size
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append(r)
    trees = []
    for tid in sorted(by_tree):
        ns = sorted(by_tree[tid], key=lambda r: r["id"])
        n = len(ns)
        left = np.full(n, -1, dtype=np.int64)
        right = np.full(n, -1, dtype=np.int64)
        feat = np.full(n, -1, dtype=np.int64)
        thr = np.zeros(n)
        value = np.zeros(n)
        cover = np.zeros(n)
        for r in ns:
            i = r["id"]
            left[i], right[i] = r["leftChild"], r["rightChild"]
            st = r["impurityStats"]
            if algo == "xgboost":
                value[i] = r["prediction"]
                cover[i] = st[0]
            else:
                tot = float(sum(st))
                value[i] = st[1] / tot if tot > 0 and len(st) > 1 else 0.0
                cover[i] = tot
            if r["leftChild"] >= 0:
                feat[i] = r["split"]["featureIndex"]
                thr[i] = r["split"]["leftCategoriesOrThreshold"][0]
        trees.append({"left": left, "right": right, "feat": feat, "thr": thr, "value": value, "cover": cover})
    if algo == "xgboost":
        weights = np.array(fitted.model.treeWeights, dtype=float)
        kind = "margin"
    else:
        weights = np.full(len(trees), 1.0 / len(trees))
        kind = "probability"
    return trees, weights, kind


def _prepared_sample(pipe, df: DataFrame, id_col: str, n_rows: int | None, seed: int) -> DataFrame:
    """Prepare the whole frame (statistics of the frame the model scores), then
    take the explained rows -- so ``fx`` equals the model's own output."""
    prepared = pipe.prep.transform(df)
    return sample_rows(prepared, id_col, n_rows, seed) if n_rows else prepared


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


# ---------------------------------------------------------------------------
# path-dependent TreeSHAP, leaf by leaf for a batch of rows
# ---------------------------------------------------------------------------

@dataclass
class LeafPath:
    """A leaf with the distinct features of its path: the interval each must lie in, and
    the share of training rows that stay on the path when the feature is unknown."""
    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


def leaf_paths(tree: dict) -> list[LeafPath]:
    out: list[LeafPath] = []
    stack = [(0, {})]
    while stack:
        j, held = stack.pop()
        if tree["left"][j] < 0:
            feats = list(held)
            rows = np.array([held[f] for f in feats], float).reshape(-1, 3)
            out.append(LeafPath(float(tree["value"][j]), np.array(feats, int), rows[:, 0], rows[:, 1], rows[:, 2]))
            continue
        f, thr = int(tree["feat"][j]), tree["thr"][j]
        low, high, share = held.get(f, (-np.inf, np.inf, 1.0))
        whole = tree["cover"][j] if tree["cover"][j] > 0 else 1.0
        for child, bounds in ((tree["left"][j], (low, min(high, thr))), (tree["right"][j], (max(low, thr), high))):
            stack.append((child, held | {f: (*bounds, share * tree["cover"][child] / whole)}))
    return out


def batch_shap(paths: list[LeafPath], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Attributions (rows x features) and outputs of one tree.

    A leaf's game gives a coalition the product of ``inside`` (0 or 1) over its members and
    of ``share`` over the others.  The Shapley weights k!(m-k-1)!/m! are the integrals of
    t^k (1-t)^(m-1-k), so a feature's value is the integral of the product of
    ``inside * t + share * (1 - t)`` over the other features, times ``inside - share``: a
    polynomial of degree m - 1, which Gauss-Legendre nodes integrate exactly.
    """
    phi, fx = np.zeros(x.shape), np.zeros(len(x))
    for p in paths:
        m = len(p.features)
        cells = x[:, p.features]
        inside = ((cells > p.low) & (cells <= p.high)).astype(float)
        fx += p.value * inside.all(axis=1)
        if m == 0:
            continue
        nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)
        for t, w in zip((nodes + 1) / 2, weights / 2):
            factor = inside * t + p.share * (1 - t)
            before = np.cumprod(np.column_stack([np.ones(len(x)), factor[:, :-1]]), axis=1)
            after = np.cumprod(np.column_stack([np.ones(len(x)), factor[:, :0:-1]]), axis=1)[:, ::-1]
            phi[:, p.features] += p.value * w * before * after * (inside - p.share)
    return phi, fx


def _expected(tree: dict) -> float:
    leaves = tree["left"] < 0
    return float(np.sum(tree["value"][leaves] * tree["cover"][leaves]) / tree["cover"][0])


def tree_shap(pipe, df: DataFrame, id_col: str = "patient_id", n_rows: int | None = SHAP_ROWS,
              seed: int = 42) -> DataFrame:
    """TreeSHAP for the rows first in ``md5(seed:id)`` order (all rows when
    ``n_rows`` is None)."""
    feats = list(pipe.features)
    trees, weights, kind = tree_tables(pipe.model)
    base = float(sum(w * _expected(t) for t, w in zip(trees, weights)))
    prepared = _prepared_sample(pipe, df, id_col, n_rows, seed).select(
        id_col, *[F.col(f).cast("double") for f in feats])
    # leaf paths: bounded by the model's leaves and depth
    shared = prepared.sparkSession.sparkContext.broadcast([(leaf_paths(t), w) for t, w in zip(trees, weights)])
    id_type = prepared.schema[id_col].dataType.simpleString()

    def explain(batches):
        for b in batches:
            x = b[feats].to_numpy(dtype=float)
            phi, fx = np.zeros(x.shape), np.zeros(len(x))
            for paths, w in shared.value:
                tree_phi, tree_fx = batch_shap(paths, x)
                phi += w * tree_phi
                fx += w * tree_fx
            k = len(feats)
            yield pd.DataFrame({id_col: np.repeat(b[id_col].to_numpy(), k), "feature": feats * len(b), "value": x.ravel(),
                                "phi": phi.ravel(), "base": base, "fx": np.repeat(fx, k)})

    schema = f"{id_col} {id_type}, feature string, value double, phi double, base double, fx double"
    return prepared.mapInPandas(explain, schema).withColumn("output", F.lit(kind))


# ---------------------------------------------------------------------------
# linear closed form and sampled permutations
# ---------------------------------------------------------------------------

def linear_shap(pipe, df: DataFrame, id_col: str = "patient_id", n_rows: int | None = SHAP_ROWS,
                seed: int = 42) -> DataFrame:
    """I7 for linear models: ``phi_i = w_i (x_i - mean_i)`` on the margin; means over
    the explained (= background) rows; ``base = w . mean + b``."""
    feats = list(pipe.features)
    m = pipe.model.model
    w = m.coefficients.toArray()
    b = float(m.intercept)
    prepared = _prepared_sample(pipe, df, id_col, n_rows, seed).select(id_col, *feats)
    means = {r["feature"]: r["mean"] for r in moments(prepared, feats).collect()}
    base = float(sum(wi * (means.get(f) or 0.0) for wi, f in zip(w, feats)) + b)
    fx = sum(F.lit(float(wi)) * F.col(f) for wi, f in zip(w, feats)) + F.lit(b)
    long = prepared.select(id_col, fx.alias("fx"), F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                 (F.lit(float(wi)) * (F.col(f) - F.lit(float(means.get(f) or 0.0)))).alias("phi"))
        for wi, f in zip(w, feats)])).alias("s"))
    return long.select(id_col, "s.feature", "s.value", "s.phi", F.lit(base).alias("base"), "fx") \
        .withColumn("output", F.lit("margin"))


def sampled_shap(pipe, df: DataFrame, id_col: str = "patient_id", n_rows: int | None = SHAP_ROWS,
                 samples: int = PERMUTATION_SAMPLES, seed: int = 42, background: int = SHAP_ROWS) -> DataFrame:
    """I7 model-agnostic: for each explained row and sample s, a background row and a
    feature order are drawn from ``md5``; the M+1 hybrid points along that order are
    scored by one transform and consecutive differences credited to the feature
    switched in.  phi = mean over samples (units: P(class 1))."""
    feats = list(pipe.features)
    M = len(feats)
    prepared = _prepared_sample(pipe, df, id_col, n_rows, seed).select(id_col, *feats)
    # ``background`` rows, the first in hash order of those explained
    bg_rows = sample_rows(prepared, id_col, background, seed).select(*feats).collect()
    nb = len(bg_rows)
    bg = prepared.sparkSession.createDataFrame(
        [(i, *[float(r[f]) for f in feats]) for i, r in enumerate(bg_rows)],
        ", ".join(["__bi long"] + [f"__b_{f} double" for f in feats]))
    draws = prepared.select(id_col, *feats, F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("__s"))
    draws = draws.withColumn("__bi", hash_order(seed, F.lit("bg"), id_col, F.col("__s")) % F.lit(nb))
    draws = draws.join(F.broadcast(bg), "__bi")
    # order of features: rank of md5(seed:perm:id:s:feature)
    keys = F.array(*[F.struct(hash_order(seed, F.lit("perm"), id_col, F.col("__s"), F.lit(f)).alias("h"),
                              F.lit(i).alias("i")) for i, f in enumerate(feats)])
    draws = draws.withColumn("__order", F.transform(F.array_sort(keys), lambda e: e["i"]))
    pos = {f: F.array_position(F.col("__order"), i) - 1 for i, f in enumerate(feats)}
    steps = draws.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(M))))
    hybrid = steps.select(id_col, "__s", "__j", "__order",
                          *[F.when(pos[f] < F.col("__j"), F.col(f)).otherwise(F.col(f"__b_{f}")).alias(f)
                            for f in feats])
    scored = pipe.model.transform(VectorAssembler(inputCols=feats, outputCol="features").transform(hybrid))
    w = Window.partitionBy(id_col, "__s").orderBy("__j")
    diffs = scored.select(id_col, "__s", "__j", "__order", "p1",
                          (F.col("p1") - F.lag("p1").over(w)).alias("d")).where(F.col("__j") > 0)
    credited = diffs.select(id_col, F.element_at(F.col("__order"), F.col("__j")).alias("__fi"), "d")
    names = F.element_at(F.array(*[F.lit(f) for f in feats]), F.col("__fi") + 1)
    phi = credited.groupBy(id_col, names.alias("feature")).agg((F.sum("d") / samples).alias("phi"))
    ends = scored.groupBy(id_col).agg(
        F.avg(F.when(F.col("__j") == 0, F.col("p1"))).alias("base_row"),
        F.avg(F.when(F.col("__j") == M, F.col("p1"))).alias("fx"))
    vals = prepared.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in feats])).alias("v")) \
        .select(id_col, "v.*")
    return (vals.join(phi, [id_col, "feature"]).join(ends, id_col)
            .select(id_col, "feature", "value", "phi", F.col("base_row").alias("base"), "fx")
            .withColumn("output", F.lit("probability")))


def shap_values(pipe, df: DataFrame, id_col: str = "patient_id", n_rows: int | None = SHAP_ROWS,
                seed: int = 42) -> DataFrame:
    """Pick the explainer like the reference: trees -> TreeSHAP, else model-agnostic
    (closed form where the model is linear in its input)."""
    algo = pipe.model.algorithm
    if algo in ("random_forest", "cart", "xgboost"):
        return tree_shap(pipe, df, id_col, n_rows, seed)
    if algo == "logistic_regression" or (algo == "svm" and pipe.model.rff is None):
        return linear_shap(pipe, df, id_col, n_rows, seed)
    return sampled_shap(pipe, df, id_col, n_rows, seed=seed)


def shap_summary(shap_df: DataFrame) -> DataFrame:
    """Mean |phi| per feature, largest first (the beeswarm's ordering data)."""
    return (shap_df.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi"),
                                          F.avg("phi").alias("mean_phi"))
            .orderBy(F.col("mean_abs_phi").desc(), "feature"))

