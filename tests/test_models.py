"""End-to-end model selection on the smallest signal cohort."""

from cohort_engine.plans.train import evaluate_independent, load_pipeline, pick_model_path, train_cohort
from cohort_engine.plans.tuning import SearchConfig
from cohort_engine.sources import fixtures as FX

from conftest import SF_SMALL


def test_nested_cv_oof_and_persistence(spark, tmp_path):
    df = FX.c5_signal(spark, SF_SMALL)
    cfg = SearchConfig(algorithm="logistic_regression", outer_folds=2, inner_folds=2,
                       grid=[{"C": 1, "penalty": "l2", "k": 5}, {"C": 0.01, "penalty": "l2", "k": 3}],
                       parallelism=4)
    res = train_cohort(df, cfg, seeds=[42], output=str(tmp_path))
    oof = res["nested"][42]["oof"]
    n = df.count()
    assert oof.count() == n and oof.select("patient_id").distinct().count() == n
    assert res["dropped_constant"] == ["constant_col"]
    summary = res["summary"].first()
    assert summary.cv_auc > 0.8 and summary.cv_mcc > 0.3          # C5 carries signal
    pipe = load_pipeline(spark, pick_model_path(spark, f"{tmp_path}/logistic_regression_anova"))
    ev = evaluate_independent(pipe, df)
    m = ev["metrics"].first()
    assert m.n == n and m.auc > 0.8
    assert sum(r.n for r in ev["confusion"].collect()) == n


def test_svm_rbf_and_forest_fit(spark):
    from cohort_engine.plans import tuning as TU
    df = FX.c5_signal(spark, SF_SMALL)
    feats = ["age", "totalprice", "qty", "price", "disc", "tax"]
    for algo, params in [("svm", {"C": 1, "kernel": "rbf", "k": 4}),
                         ("random_forest", {"n_estimators": 10, "max_depth": 4, "k": 4}),
                         ("cart", {"max_depth": None, "min_samples_split": 10, "k": 4}),
                         ("xgboost", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1, "k": 4})]:
        cfg = TU.SearchConfig(algorithm=algo)
        pipe = TU.refit(df, feats, params, cfg, "oversampling", 42)
        pred = pipe.predict(df).select("prediction", "p1").toPandas()
        assert len(pred) == df.count() and pred.p1.between(0, 1).all()


def test_released_splits_leave_no_shuffle_files(spark):
    """what a split shuffled goes when it is released, not when the driver happens to collect."""
    import glob
    import os
    import time

    from cohort_engine.plans import tuning as TU
    rows = [(i, i % 3 // 2, float(i % 5), float(i * 7919 % 1009), float(i % 13)) for i in range(20_000)]
    df = spark.createDataFrame(rows, "patient_id long, response int, batch double, a double, b double").persist()
    local = spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    held = lambda: sum(os.path.getsize(f) for d in local for f in glob.glob(f"{d}/*/shuffle_*.data"))        # noqa: E731
    TU.drop_unreferenced(spark)
    time.sleep(5)
    before = held()
    split = TU.prepare_split(df, None, ["a", "b"], TU.SearchConfig(algorithm="logistic_regression"), "oversampling", 42)
    used = held() - before
    split.release()
    until = time.time() + 20
    while held() > before + used / 4 and time.time() < until:
        time.sleep(0.5)
    assert used > 100_000 and held() <= before + used / 4


def test_few_means_are_broadcast(spark):
    """rows do not move by their batch when the counted means are few."""
    from cohort_engine.operators import prep as P
    df = spark.createDataFrame([(i, float(i % 4), float(i)) for i in range(2_000)], "patient_id long, batch double, a double")
    out, moments = P.batch_center(df, ["a"], "batch", with_moments=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert out.count() == 2_000 and abs(moments["a"][1] - (4 * (500 ** 2 - 1) / 3) ** 0.5) < 1e-6
