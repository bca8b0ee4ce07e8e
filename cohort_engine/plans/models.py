"""Estimators (E1-E7) and their parameter grids (G1) on ``pyspark.ml``.

Regularisation is mapped from the reference's ``C`` (penalty on the summed loss)
to Spark's ``regParam`` (penalty on the mean loss): ``regParam = 1 / (C * n)``
with ``n`` the training rows after resampling.
"""

from __future__ import annotations

import itertools
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohort_engine.plans import multi_svm as SV

ALIASES = {"lr": "logistic_regression", "logistic": "logistic_regression", "rf": "random_forest",
           "xgb": "xgboost", "gbt": "xgboost", "tree": "cart"}

# fixed values: the reference's model grids
MODEL_GRIDS: dict[str, dict[str, list]] = {
    "logistic_regression": {"C": [0.01, 0.1, 1, 10], "penalty": ["l2"]},
    "svm": {"C": [0.1, 1, 10], "kernel": ["linear", "rbf"]},
    "xgboost": {"n_estimators": [100, 200], "max_depth": [3, 6], "learning_rate": [0.01, 0.1]},
    "random_forest": {"n_estimators": [100, 200], "max_depth": [None, 10, 20]},
    "cart": {"max_depth": [None, 10, 20], "min_samples_split": [2, 10]},
}
LASSO_ALPHAS = [0.001, 0.01, 0.1, 1]

# fixed values: the reference estimators' default stopping tolerances and the
# number of internal folds behind SVM probabilities
LR_TOL = 1e-4
SVM_TOL = 1e-3
CALIBRATION_FOLDS = 5

SPARK_MAX_DEPTH = 30          # Spark's tree depth limit stands in for "unlimited"
RFF_COMPONENTS = 200          # random Fourier features for the RBF kernel, unless asked otherwise


def canonical(algorithm: str) -> str:
    a = ALIASES.get(algorithm, algorithm)
    if a not in MODEL_GRIDS:
        raise ValueError(f"no such estimator: {algorithm!r}")          # E7
    return a


def param_grid(selection: str, algorithm: str, k_values: list[int]) -> list[dict]:
    """G1: model grid x selection grid, in the reference's enumeration order."""
    grid = dict(MODEL_GRIDS[canonical(algorithm)])
    if selection in ("anova", "mutual_info", "rfe"):
        grid["k"] = list(k_values)
    elif selection == "lasso":
        grid["alpha"] = list(LASSO_ALPHAS)
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*(grid[k] for k in keys))]


def model_params(params: dict) -> dict:
    return {k: v for k, v in params.items() if k not in ("k", "alpha")}


@dataclass
class FittedModel:
    """A fitted Spark model plus the pieces needed to score like the reference."""
    algorithm: str
    params: dict
    model: object
    platt: object | None = None           # SVM: logistic calibration of out-of-fold margins
    rff: tuple | None = None              # RBF SVM: (W, b) of the feature map

    def transform(self, df: DataFrame, features_col: str = "features") -> DataFrame:
        """Adds ``prediction`` (double) and ``p1`` (P(class 1))."""
        src = _rff_map(df, features_col, *self.rff) if self.rff is not None else df
        out = self.model.transform(src)
        if self.algorithm == "svm":
            # the class is the margin's sign; the calibration gives the probability alone
            out = out.withColumn("__margin", vector_to_array("rawPrediction")[1]).drop("rawPrediction", "probability")
            return out.withColumn("p1", self.p1_of(F.col("__margin"))).drop("__margin")
        return out.withColumn("p1", vector_to_array("probability")[1]).drop("rawPrediction", "probability")

    def linear_terms(self) -> tuple[np.ndarray, float] | None:
        """Coefficients and intercept of a margin that is linear in the model's input, None for other models."""
        if self.rff is None and self.algorithm in ("logistic_regression", "svm"):
            return self.model.coefficients.toArray(), float(self.model.intercept)
        return None

    def p1_of(self, margin: Column) -> Column:
        """P(class 1) of a linear margin."""
        if self.algorithm == "svm" and self.platt is not None:
            margin = margin * float(self.platt.coefficients[0]) + float(self.platt.intercept)
        return 1 / (1 + F.exp(-margin))

    def rule(self, df: DataFrame, id_col: str = "patient_id", features_col: str = "features") -> DataFrame:
        """``(id, own)``: the class by the estimator's own decision value, apart from any calibration."""
        src = _rff_map(df, features_col, *self.rff) if self.rff is not None else df
        side = vector_to_array("rawPrediction")
        out = self.model.transform(src)
        return out.select(id_col, F.when(side[1] > (0 if self.algorithm == "svm" else side[0]), 1.0).otherwise(0.0).alias("own"))


def _rff_map(df: DataFrame, col: str, W: np.ndarray, b: np.ndarray) -> DataFrame:
    """z = sqrt(2/D) cos(W x + b), vectorised per Arrow batch."""
    scale = math.sqrt(2.0 / W.shape[0])

    @F.pandas_udf("array<double>")
    def rff(x: pd.Series) -> pd.Series:
        X = np.stack(x.to_numpy()) if len(x) else np.zeros((0, W.shape[1]))
        Z = scale * np.cos(X @ W.T + b)
        return pd.Series(list(Z))

    return df.withColumn(col, array_to_vector(rff(vector_to_array(col))))


def fit(algorithm: str, params: dict, train: DataFrame, n_train: int, label: str = "label",
        features_col: str = "features", seed: int = 42, calibrate: bool = True,
        rff_components: int = RFF_COMPONENTS, weight: str | None = None) -> FittedModel:
    """Fit one candidate on an assembled training frame.

    ``calibrate`` learns SVM probabilities (``CALIBRATION_FOLDS`` further fits); a search
    that compares classes only does without.  ``rff_components`` is the width of the
    feature map behind the RBF kernel.  ``weight`` names the column that says how often a
    row counts; ``n_train`` is the sum of it."""
    a = canonical(algorithm)
    p = model_params(params)
    w = {"weightCol": weight} if weight else {}
    if a == "logistic_regression":
        est = LogisticRegression(featuresCol=features_col, labelCol=label, **w, maxIter=1000, elasticNetParam=0.0,
                                 regParam=1.0 / (float(p["C"]) * n_train), standardization=False, tol=LR_TOL)
        return FittedModel(a, params, est.fit(train))
    if a == "svm":
        rff = None
        src = train
        if p.get("kernel", "linear") == "rbf":
            rff = _rff_weights(train, features_col, seed, rff_components, weight)
            src = _rff_map(train, features_col, *rff)
        svc = LinearSVC(featuresCol=features_col, labelCol=label, **w, regParam=1.0 / (float(p["C"]) * n_train),
                        maxIter=1000, standardization=False, tol=SVM_TOL)
        first = train.select(features_col).first()
        if first is not None and (rff[0].shape[0] if rff is not None else len(first[0])) <= SV.MAX_FEATURES:
            return _svms_together(a, params, train, svc, features_col, label, seed, weight, rff, calibrate)
        m = svc.fit(src)
        if not calibrate:
            return FittedModel(a, params, m, None, rff)
        return FittedModel(a, params, m, _platt(_oof_margins(src, svc, features_col, label, seed, weight), label, w), rff)
    if a == "xgboost":
        est = GBTClassifier(featuresCol=features_col, labelCol=label, **w, maxIter=int(p["n_estimators"]),
                            maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
                            lossType="logistic", seed=seed)
        return FittedModel(a, params, est.fit(train))
    if a == "random_forest":
        depth = SPARK_MAX_DEPTH if p["max_depth"] is None else int(p["max_depth"])
        est = RandomForestClassifier(featuresCol=features_col, labelCol=label, **w, numTrees=int(p["n_estimators"]),
                                     maxDepth=depth, featureSubsetStrategy="sqrt", seed=seed)
        return FittedModel(a, params, est.fit(train))
    depth = SPARK_MAX_DEPTH if p["max_depth"] is None else int(p["max_depth"])
    # no minimum-split parameter in Spark: a split needs both children >= half of it
    min_node = max(1, int(p.get("min_samples_split", 2)) // 2)
    est = DecisionTreeClassifier(featuresCol=features_col, labelCol=label, **w, maxDepth=depth,
                                 minInstancesPerNode=min_node, seed=seed)
    return FittedModel(a, params, est.fit(train))


def _platt(margins: DataFrame, label: str, weight: dict):
    """Logistic calibration of out-of-fold margins ``__m``."""
    return LogisticRegression(featuresCol="__mv", labelCol=label, **weight, regParam=0.0, maxIter=100).fit(
        margins.select(label, *weight.values(), array_to_vector(F.array("__m")).alias("__mv")))


def _calibration_fold(features_col: str, label: str, seed: int) -> Column:
    """Folds hash the row's content, so resampled copies of a row share a fold."""
    return F.pmod(F.xxhash64(F.lit(seed), vector_to_array(features_col), F.col(label)), F.lit(CALIBRATION_FOLDS))


def _svms_together(algorithm: str, params: dict, train: DataFrame, svc: LinearSVC, features_col: str, label: str, seed: int, weight: str | None,
                   rff: tuple | None, calibrate: bool) -> FittedModel:
    """The SVM of all rows and those behind its probabilities, a pass over the rows for a step of all of them."""
    fold = _calibration_fold(features_col, label, seed) if calibrate else F.lit(SV.NONE - 1)
    rows = train.select(F.col(label).cast("double").alias("label"), vector_to_array(features_col).alias("x"),
                        (F.col(weight) if weight else F.lit(1)).cast("double").alias("w"), fold.cast("int").alias("fold")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = SV.fit_svms(rows, range(CALIBRATION_FOLDS) if calibrate else (), svc.getRegParam(), rff)
        platt = None
        if calibrate:
            margins = SV.margins_left_out(rows, {k: v for k, v in fits.items() if k != SV.NONE}, rff)
            platt = _platt(margins.select("label", "w", F.col("m").alias("__m")), "label", {"weightCol": "w"})
    finally:
        rows.unpersist()
    return FittedModel(algorithm, params, SV.as_model(fits[SV.NONE], svc), platt, rff)


def _oof_margins(src: DataFrame, svc: LinearSVC, features_col: str, label: str, seed: int, weight: str | None = None) -> DataFrame:
    """SVM margins of each training row from a model that did not see it
    (``CALIBRATION_FOLDS``-fold, as the reference's probability calibration)."""
    keyed = src.withColumn("__cf", _calibration_fold(features_col, label, seed))

    def margins(f: int) -> DataFrame:
        mf = svc.fit(keyed.where(F.col("__cf") != f))
        return (mf.transform(keyed.where(F.col("__cf") == f))
                .select(label, *([weight] if weight else []), vector_to_array("rawPrediction")[1].alias("__m")))

    # a fit is many short jobs one after the other, so the folds' jobs run side by side
    with ThreadPoolExecutor(max_workers=CALIBRATION_FOLDS) as pool:
        return reduce(DataFrame.unionByName, pool.map(margins, range(CALIBRATION_FOLDS)))


def _rff_weights(train: DataFrame, features_col: str, seed: int, components: int, weight: str | None = None) -> tuple[np.ndarray, np.ndarray]:
    """gamma = 1 / (p * Var(X)) over all training cells ('scale'), W ~ N(0, 2 gamma)."""
    arr = train.select(F.explode(vector_to_array(features_col)).alias("x"), (F.col(weight) if weight else F.lit(1)).alias("w"))
    center = arr.agg(F.sum(F.col("x") * F.col("w")) / F.sum("w")).first()[0] or 0.0
    row = arr.agg((F.sum(F.col("w") * (F.col("x") - center) ** 2) / F.sum("w")).alias("v")).first()
    first = train.select(features_col).first()
    p = len(first[0]) if first is not None else 1
    var = row["v"] or 1.0
    gamma = 1.0 / (p * var) if var > 0 else 1.0
    rng = np.random.default_rng(seed)
    W = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(components, p))
    b = rng.uniform(0.0, 2 * math.pi, size=components)
    return W, b


def importances(fitted: FittedModel, names: list[str]) -> list[tuple[str, float]]:
    """Tree importances, else |coefficients|, else zeros."""
    m = fitted.model
    if hasattr(m, "featureImportances") and fitted.algorithm in ("xgboost", "random_forest", "cart"):
        vals = m.featureImportances.toArray()
    elif hasattr(m, "coefficients") and fitted.rff is None:
        vals = np.abs(m.coefficients.toArray())
    else:
        vals = np.zeros(len(names))
    return [(n, float(v)) for n, v in zip(names, vals)]
