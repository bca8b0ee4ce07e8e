"""Interpretation: SHAP additivity, ICE independence, SVM classes, drop-column, isolation forest on sparse columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_engine.operators import columns as C
from cohort_engine.operators.explain import drop_column_importance, ice_curves, model_importance, permutation_importance
from cohort_engine.operators.isoforest import isolation_report
from cohort_engine.operators.shap import batch_shap, leaf_paths, sampled_shap, shap_values
from cohort_engine.plans.pipeline_prep import cohort_features
from cohort_engine.plans.tuning import SearchConfig, refit
from cohort_engine.sources import fixtures as FX
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def cohort(spark):
    df = FX.c5_signal(spark, SF_SMALL).persist()
    enc = C.encode_sex(df)
    return df, C.drop_constant(enc, cohort_features(enc))[1]


def fit(cohort, algorithm, params):
    df, kept = cohort
    return refit(df, kept, params, SearchConfig(algorithm=algorithm), "oversampling", 42)


def brute_shap(tree, x, feats):
    from itertools import combinations
    from math import factorial

    def value(j, known):
        if tree["left"][j] < 0:
            return tree["value"][j]
        f, l, r = tree["feat"][j], tree["left"][j], tree["right"][j]
        if f in known:
            return value(l if x[f] <= tree["thr"][j] else r, known)
        return (tree["cover"][l] * value(l, known) + tree["cover"][r] * value(r, known)) / tree["cover"][j]

    out = []
    for i in range(feats):
        rest = [k for k in range(feats) if k != i]
        out.append(sum(factorial(len(s)) * factorial(feats - len(s) - 1) / factorial(feats) * (value(0, {*s, i}) - value(0, set(s)))
                       for size in range(feats) for s in combinations(rest, size)))
    return np.array(out)


def test_tree_values_against_all_coalitions():
    rng = np.random.default_rng(0)
    tree = {k: [] for k in ("left", "right", "feat", "thr", "value", "cover")}

    def grow(depth, cover):
        j = len(tree["left"])
        for k in tree:
            tree[k].append(-1)
        tree["cover"][j], tree["value"][j], tree["thr"][j] = cover, rng.normal(), 0.0
        if depth:
            part = rng.uniform(0.1, 0.9) * cover
            tree["feat"][j], tree["thr"][j] = int(rng.integers(0, 4)), rng.normal()
            tree["left"][j] = grow(depth - 1, part)
            tree["right"][j] = grow(depth - 1, cover - part)
        return j

    grow(5, 100.0)
    tree = {k: np.array(v) for k, v in tree.items()}
    x = rng.normal(size=(20, 4))
    phi, fx = batch_shap(leaf_paths(tree), x)
    for i in range(20):
        assert np.allclose(phi[i], brute_shap(tree, x[i], 4), atol=1e-12)


@pytest.mark.parametrize("algorithm,params", [
    ("random_forest", {"n_estimators": 5, "max_depth": 6, "k": 5}), ("xgboost", {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.1, "k": 5}),
    ("cart", {"max_depth": None, "min_samples_split": 2, "k": 4}), ("logistic_regression", {"C": 1, "penalty": "l2", "k": 5}),
    ("svm", {"C": 1, "kernel": "linear", "k": 4})])
def test_additivity_on_all_rows(cohort, algorithm, params):
    df, _ = cohort
    pipe = fit(cohort, algorithm, params)
    rows = shap_values(pipe, df, n_rows=None).groupBy("patient_id").agg((F.first("base") + F.sum("phi") - F.first("fx")).alias("miss"), F.first("fx").alias("fx"))
    assert rows.count() == df.count() and rows.where("abs(miss) > 1e-9").count() == 0
    if algorithm in ("random_forest", "cart"):
        both = rows.join(pipe.predict(df).select("patient_id", "p1"), "patient_id")
        assert both.where("abs(fx - p1) > 1e-9").count() == 0
    assert model_importance(pipe).count() == len(pipe.features)


def test_svm(cohort):
    df, _ = cohort
    pipe = fit(cohort, "svm", {"C": 1, "kernel": "rbf", "k": 3})
    assembled = pipe.assemble(df)
    scored = pipe.model.transform(assembled).join(pipe.model.rule(assembled), "patient_id")
    assert scored.where("prediction <> own OR p1 < 0 OR p1 > 1").count() == 0
    shap = sampled_shap(pipe, df, n_rows=5, samples=4, background=7)
    off = shap.groupBy("patient_id").agg((F.first("base") + F.sum("phi") - F.first("fx")).alias("m")).where("abs(m) > 1e-9")
    assert off.count() == 0


def test_ice_curves_stand_alone(cohort):
    df, _ = cohort
    pipe = fit(cohort, "logistic_regression", {"C": 1, "penalty": "l2", "k": 5})
    alone = ice_curves(pipe, df, features=["qty"])
    together = ice_curves(pipe, df, features=["price", "qty", "sex"])
    both = alone.join(together.withColumnRenamed("p1", "q1"), ["patient_id", "feature", "grid_value"])
    assert both.count() == alone.count() and both.where("abs(p1 - q1) > 1e-12").count() == 0
    assert alone.select("patient_id").distinct().count() == df.count()
    assert sorted(r[0] for r in together.where("feature = 'sex'").select("grid_value").distinct().collect()) == [0.0, 1.0]
    # a row's curve passes through its own prediction
    own = pipe.predict(df).select("patient_id", F.col("p1").alias("own"))
    at = together.where("feature = 'sex'").join(C.encode_sex(df).select("patient_id", "sex"), "patient_id").where("grid_value = sex").join(own, "patient_id")
    assert at.count() == df.count() and at.where("abs(p1 - own) > 1e-9").count() == 0


def test_importances(cohort):
    df, _ = cohort
    pipe = fit(cohort, "logistic_regression", {"C": 1, "penalty": "l2", "k": 3})
    drop = {r.feature: r for r in drop_column_importance(pipe, df).collect()}
    assert set(drop) == set(pipe.features) and max(r.mcc_drop for r in drop.values()) > 0.01
    one = fit(cohort, "logistic_regression", {"C": 1, "penalty": "l2", "k": 1})
    assert [(r.mcc_drop, r.f1_drop) for r in drop_column_importance(one, df).collect()] == [(0.0, 0.0)]
    perm = permutation_importance(pipe, df, repeats=2).collect()
    assert {r.feature for r in perm} == set(pipe.features)


def test_isolation_forest_ignores_nulls(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=3000)
    rows = [(i, float(v[i]), float(v[i]) if i % 20 == 0 else None) for i in range(3000)]
    got = {r.feature: r.outlier_share for r in isolation_report(spark.createDataFrame(rows, "patient_id long, full double, sparse double"), ["full", "sparse"]).collect()}
    dense = [(i, float(v[i])) for i in range(0, 3000, 20)]
    alone = isolation_report(spark.createDataFrame(dense, "patient_id long, sparse double"), ["sparse"]).first().outlier_share
    assert abs(got["sparse"] * 20 - alone) < 0.15 and 0.2 < got["full"] < 0.9


def test_points_are_prepared_once_a_batch(cohort):
    """A point's prepared value is made for each batch, not for each row; trees are scored at the same values."""
    from cohort_engine.operators.explain import ice_grid, prepared_points
    df, _ = cohort
    pipe = fit(cohort, "cart", {"max_depth": 4, "min_samples_split": 2, "k": 3})
    enc = C.encode_sex(df)
    frozen, grid = pipe.prep.frozen(enc), ice_grid(enc, ["sex", "qty"])
    ready, batch = prepared_points(frozen, enc, grid)
    assert batch == "batch" and ready.count() == df.select("batch").distinct().count()
    few = enc.orderBy("patient_id").limit(20)
    points = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(v).alias("grid_value")) for f, v in grid])
    wide = few.select("*", F.inline(points)).withColumns({f: F.when(F.col("feature") == f, F.col("grid_value")).otherwise(F.col(f)) for f in ("sex", "qty")})
    whole = pipe.score(frozen.transform(wide)).select("patient_id", "feature", "grid_value", F.col("p1").alias("q1"))
    both = whole.join(ice_curves(pipe, df, features=["sex", "qty"]), ["patient_id", "feature", "grid_value"])
    assert both.count() == 20 * len(grid) and both.where("abs(p1 - q1) > 1e-9").count() == 0


def test_repeats_leave_no_shuffle_files(cohort):
    """each repeat's files go when it is counted."""
    import glob
    import os
    df, _ = cohort
    pipe = fit(cohort, "logistic_regression", {"C": 1, "penalty": "l2", "k": 3})
    spark = df.sparkSession
    local = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    held = lambda: sum(os.path.getsize(f) for d in local for f in glob.glob(f"{d}/*/shuffle_*.data"))        # noqa: E731
    grown = []
    for repeats in (1, 4):
        before = held()
        permutation_importance(pipe, df, repeats=repeats).collect()
        grown.append(held() - before)
    assert grown[1] < 2 * grown[0] + (64 << 10)


def test_curves_are_dealt_by_cells(cohort, monkeypatch):
    """rows are unfolded in as many tasks as their cells ask for, not one for each batch; rounded as Spark rounds."""
    from cohort_engine.operators import explain as E
    monkeypatch.setattr(E, "CELLS_PER_TASK", 10_000)
    df, _ = cohort
    pipe = fit(cohort, "logistic_regression", {"C": 1, "penalty": "l2", "k": 3})
    plain = ice_curves(pipe, df, features=["sex", "qty"])
    cells = plain.count()
    assert plain.rdd.getNumPartitions() >= cells // 10_000
    points = lambda t: sorted(map(tuple, t.collect()))                                                   # noqa: E731
    want = plain.select("patient_id", "feature", (F.round("grid_value", 6) + 0.0).alias("g"), (F.round("p1", 6) + 0.0).alias("p1"))
    got = ice_curves(pipe, df, features=["sex", "qty"], digits=6)
    assert points(got) == points(want)


def test_rounding_by_arithmetic(spark):
    from cohort_engine.functions.expressions import round_column
    rng = np.random.default_rng(5)
    ties = [k / 64 + 0.5 ** 7 for k in range(-50, 50)] + [0.0000005, -0.0000005, 1.0000015, 0.1234565, 2.5e-6, -1e-9]
    odd = [None, float("nan"), float("inf"), -float("inf"), 1e300, -1e12 - 0.1234565, 999.9999995, 0.0, -0.0]
    values = [*map(float, rng.uniform(-2, 2, 20_000)), *map(float, rng.uniform(-1e5, 1e5, 5_000)), *ties, *odd]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double")
    both = round_column(df, "v", 6).withColumnRenamed("v", "a").join(df.select("i", (F.round("v", 6) + 0.0).alias("b")), "i")
    assert both.count() == len(values) and both.where("NOT a <=> b").count() == 0


@pytest.mark.parametrize("algorithm,params", [("logistic_regression", {"C": 1, "penalty": "l2", "k": 4}), ("cart", {"max_depth": 4, "min_samples_split": 2, "k": 3})])
def test_donors_meet_receivers_where_they_are_sorted(cohort, algorithm, params, monkeypatch):
    """the accuracies of the copies that ``permuted_copies`` makes row by row; donors are shuffled once, packed."""
    from pyspark.ml.feature import VectorAssembler

    from cohort_engine.operators import explain as E
    df, _ = cohort
    pipe = fit(cohort, algorithm, params)
    base = pipe.prep.transform(df).select("patient_id", F.col("response").cast("double").alias("__label"), *pipe.features).persist()
    ranked = E.ranked_by_id(base, "patient_id", 5).persist()
    n = base.count()
    counts = E.donor_counts(ranked, pipe.features, "patient_id", 2, 42, 5)
    assert (counts.sum(axis=2) == n).all()
    got = {(f, r): acc for r in range(2) for f, acc in E.permuted_hits(ranked, pipe.model, pipe.features, "patient_id", r, 42, counts[r])}
    copies = E.permuted_copies(base, pipe.features, "patient_id", repeats=2)
    scored = pipe.model.transform(VectorAssembler(inputCols=pipe.features, outputCol="features").transform(copies))
    want = {(r["__f"], r["__rep"]): r["acc"] for r in scored.groupBy("__f", "__rep").agg(F.avg((F.col("__label") == F.col("prediction")).cast("double")).alias("acc")).collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
