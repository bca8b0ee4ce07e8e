"""Support vector machines of all folds together: their objective, their margins, the passes they take."""

import numpy as np
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohort_engine.plans import models as MD
from cohort_engine.plans import multi_svm as SV


def table(spark, n=1500):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    y = (np.abs(x[:, 0]) + 0.3 * x[:, 1] + rng.normal(scale=0.5, size=n) > 0.8).astype(float)
    rows = [(float(a), [float(v) for v in b], float(i % 3)) for i, (a, b) in enumerate(zip(y, x))]
    return (spark.createDataFrame(rows, "label double, x array<double>, w double").withColumn("features", array_to_vector("x")).repartition(3).persist(),
            x, y, np.array([r[2] for r in rows]))


def objective(z, y, w, beta, intercept, reg):
    return (w * np.maximum(0, 1 - (2 * y - 1) * (z @ beta + intercept))).sum() / w.sum() + reg / 2 * (beta @ beta)


def test_no_solver_of_spark_gets_lower(spark):
    """both kernels, weighted rows, rows of weight 0."""
    df, x, y, w = table(spark)
    for kernel in ("linear", "rbf"):
        m = MD.fit("svm", {"C": 1, "kernel": kernel}, df, int(w.sum()), weight="w", rff_components=40)
        src = df if m.rff is None else MD._rff_map(df, "features", *m.rff)
        theirs = LinearSVC(featuresCol="features", labelCol="label", weightCol="w", regParam=1 / w.sum(), maxIter=200, standardization=False, tol=1e-4).fit(src)
        z = SV.feature_map(m.rff)(x)[:, :-1]
        own, other = (objective(z, y, w, v.coefficients.toArray(), v.intercept, 1 / w.sum()) for v in (m.model, theirs))
        assert own <= other * (1 + 2 * SV.TOLERANCE)
        both = m.transform(df).join(m.rule(df, "x"), "x")
        assert both.where("prediction <> own OR p1 < 0 OR p1 > 1").count() == 0 and both.count() == df.count()


def test_margins_come_from_the_fit_without_the_row(spark):
    df, x, y, w = table(spark)
    rows = df.select("label", "x", "w", F.pmod(F.hash("x"), F.lit(2)).alias("fold")).persist()
    fits = SV.fit_svms(rows, [0, 1], 0.01)
    got = {tuple(r.x): r.m for r in rows.withColumn("m", F.lit(0.0)).select("x", "m").collect()}
    for f in (0, 1):
        part = rows.where(F.col("fold") == f).coalesce(1)
        want = np.array([r.x for r in part.collect()]) @ fits[f][:-1] + fits[f][-1]
        assert np.allclose(sorted(want), sorted(r.m for r in SV.margins_left_out(part, {0: fits[0], 1: fits[1]}).collect()))
        alone = SV.fit_svms(rows.where(F.col("fold") != f), [], 0.01)[SV.NONE]
        z, yy, ww = (np.array(v) for v in zip(*((r.x, r.label, r.w) for r in rows.where(F.col("fold") != f).collect())))
        assert abs(objective(z, yy, ww, fits[f][:-1], fits[f][-1], 0.01) / objective(z, yy, ww, alone[:-1], alone[-1], 0.01) - 1) < 5 * SV.TOLERANCE
    assert len(got) == 1500


def test_one_class_and_wrong_labels(spark):
    import pytest
    df, *_ = table(spark, 60)
    one = MD.fit("svm", {"C": 1, "kernel": "linear"}, df.withColumn("label", F.lit(0.0)), 60, calibrate=False)
    assert one.transform(df).where("prediction <> 0").count() == 0
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        MD.fit("svm", {"C": 1, "kernel": "linear"}, df.withColumn("label", F.lit(2.0)), 60, calibrate=False)


def test_fits_share_their_passes(spark):
    """the machine and its five calibration fits took more than a thousand jobs, one a step and fit."""
    df, _, _, w = table(spark)
    last = lambda: spark.range(1).count() and max(spark.sparkContext.statusTracker().getJobIdsForGroup())        # noqa: E731
    before = last()
    MD.fit("svm", {"C": 1, "kernel": "rbf"}, df, int(w.sum()), weight="w", rff_components=40)
    assert last() - before < 200
