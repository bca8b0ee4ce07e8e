"""Outlier screens: isolation forest pieces and PCA reconstruction vs numpy."""

import numpy as np
from pyspark.sql import functions as F

from cohort_engine.operators.isoforest import average_path_length, grow_intervals, isolation_report
from cohort_engine.operators.outliers import pca_report


def test_average_path_length():
    c = average_path_length(np.array([1, 2, 3, 256]))
    assert c[0] == 0 and c[1] == 1
    assert abs(c[2] - (2 * (np.log(2) + 0.5772156649015329) - 4 / 3)) < 1e-12
    assert 10.2 < c[3] < 10.3


def test_tree_partitions_the_line():
    rng = np.random.default_rng(0)
    leaves = grow_intervals(rng.normal(size=256), np.random.default_rng(1), 8)
    ups = [u for u, _ in leaves]
    assert ups[-1] == np.inf and all(a < b for a, b in zip(ups, ups[1:]))
    assert all(0 <= h <= 8 + average_path_length(256) for _, h in leaves)


def test_planted_outliers_flagged(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(size=2000)
    a[:200] = rng.uniform(40, 60, 200)                     # 10 % far away
    b = rng.normal(size=2000)
    df = spark.createDataFrame([(i, float(a[i]), float(b[i])) for i in range(2000)], "patient_id long, a double, b double")
    rep = {r.feature: r for r in isolation_report(df, ["a", "b"], threshold=0.05).collect()}
    assert rep["a"].flagged and rep["a"].outlier_share >= 0.1
    assert 0.0 < rep["b"].outlier_share < 0.5


def test_pca_reconstruction_matches_numpy(spark):
    rng = np.random.default_rng(5)
    X = rng.normal(size=(400, 6)) @ rng.normal(size=(6, 6))
    cols = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([tuple(float(v) for v in r) for r in X], ", ".join(f"{c} double" for c in cols))
    got = {r.feature: r.reconstruction_error for r in pca_report(df, cols, threshold=0.1, n_components=3).collect()}
    Xc = X - X.mean(axis=0)
    _, _, vt = np.linalg.svd(Xc, full_matrices=False)
    V = vt[:3].T
    err = np.abs(Xc - Xc @ V @ V.T).mean(axis=0)
    for i, c in enumerate(cols):
        assert abs(got[c] - err[i]) < 1e-6
