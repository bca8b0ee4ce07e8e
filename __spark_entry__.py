"""

Every query reads the driver tables through the fixture cohorts
(``cohort_engine.sources.fixtures``) and runs one operator over the whole cohort.
``oracle_sql`` holds an independent DuckDB formulation of the same result.
Floating outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np  # noqa: E402
from pyspark import StorageLevel  # noqa: E402
from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from cohort_engine.operators import blocks as B  # noqa: E402
from cohort_engine.operators import columns as C  # noqa: E402
from cohort_engine.operators import metrics as M  # noqa: E402
from cohort_engine.operators import outliers as O  # noqa: E402
from cohort_engine.operators import prep as P  # noqa: E402
from cohort_engine.operators import select as S  # noqa: E402
from cohort_engine.operators import stats as A  # noqa: E402
from cohort_engine.plans.folds import stratified_folds  # noqa: E402
from cohort_engine.plans.pipeline_prep import Preparer, cohort_features  # noqa: E402
from cohort_engine.sources import fixtures as FX  # noqa: E402
from cohort_engine.sources.tables import union_cohorts  # noqa: E402
from cohort_engine.session import ensure_checkpoint_dir, ship_package  # noqa: E402
from cohort_engine.sources.validate import coerce, violations  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
DIGITS = 6


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating column to ``DIGITS`` decimals (both engines do the same)."""
    return df.select(*[(F.round(F.col(f.name), DIGITS) + 0.0).alias(f.name)          # + 0.0: no negative zero
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which features separate the classes best?  C1 -> validate -> drop constant
    columns -> normalise (log2 | z-score, median fill, batch centring) -> standardise
    -> impute -> ANOVA F, ranked; the top-k report (k from the k-range rule)."""
    raw = coerce(FX.c1_orders(spark, sf_dir))
    feats = cohort_features(raw)
    _, kept, _ = C.drop_constant(C.encode_sex(raw), feats)
    preparer = Preparer(kept)
    _, prepared = preparer.fit(raw.select("patient_id", "response", "batch", *kept))
    scores = S.anova_f(prepared, kept, "response")
    k = S.k_range(len(kept))[0]
    top = rounded(S.top_k(scores, k)).collect()            # k rows: the report itself
    preparer.release()
    return spark.createDataFrame(top, "feature string, f_score double")


def q_c1_cohort(spark, d):
    return rounded(FX.c1_orders(spark, d))


def q_c3_cohort(spark, d):
    return rounded(FX.c3_documents(spark, d))


def q_c2_cohort(spark, d):
    return rounded(FX.c2_embeddings(spark, d))


def q_c4_scores(spark, d):
    return rounded(FX.c4_scores(spark, d))


def q_c5_cohort(spark, d):
    return rounded(FX.c5_signal(spark, d))


def q_anova_topk_c2(spark, d):
    """F1 + F5: ANOVA F of 64 embedding features, top k by the k-range rule (k = 60)."""
    c2 = FX.c2_embeddings(spark, d)
    k = S.k_range(len(FX.C2_FEATURES))[-1]
    return rounded(S.top_k(S.anova_f(c2, FX.C2_FEATURES, "response"), k))


def q_mutual_info_c2(spark, d):
    from cohort_engine.operators.mutual_info import mutual_info
    return rounded(mutual_info(FX.c2_embeddings(spark, d), FX.C2_FEATURES, "response", "patient_id"))


def q_dirty_violations(spark, d):
    return violations(FX.dirty_orders(spark, d))


def q_dirty_coerced(spark, d):
    return rounded(coerce(FX.dirty_orders(spark, d)))


def q_cohort_union(spark, d):
    return rounded(union_cohorts([FX.c1_orders(spark, d), FX.c5_signal(spark, d)], "source"))


def q_constant_columns(spark, d):
    c1 = C.encode_sex(FX.c1_orders(spark, d))
    return rounded(C.constant_columns(c1, cohort_features(c1)))


def q_align_columns(spark, d):
    c3 = FX.c3_documents(spark, d)
    train = ["n_words", "n_chars", "absent_marker", "digit_share"]
    return rounded(C.align_columns(c3, train, keep=["patient_id", "response"]))


def q_class_balance(spark, d):
    return rounded(A.class_balance(FX.c2_embeddings(spark, d), "response"))


def q_feature_ranges(spark, d):
    c1 = FX.c1_orders(spark, d)
    return rounded(A.feature_ranges(c1, FX.C1_FEATURES))


def q_any_negative(spark, d):
    return A.any_negative(FX.c2_embeddings(spark, d), FX.C2_FEATURES)


def q_moments(spark, d):
    return rounded(A.moments(FX.c2_embeddings(spark, d), FX.C2_FEATURES))


def q_medians(spark, d):
    return rounded(A.medians(FX.c1_orders(spark, d), FX.C1_FEATURES))


def q_quartiles(spark, d):
    return rounded(A.quartiles(FX.c2_embeddings(spark, d), FX.C2_FEATURES))


def q_log2(spark, d):
    c1 = FX.c1_orders(spark, d)
    return rounded(P.log2_normalize(c1, FX.C1_FEATURES))


def q_zscore(spark, d):
    return rounded(P.zscore_normalize(FX.c2_embeddings(spark, d), FX.C2_FEATURES))


def q_fill_bad(spark, d):
    c1 = P.log2_normalize(FX.c1_orders(spark, d), FX.C1_FEATURES)
    return rounded(P.fill_bad(c1, FX.C1_FEATURES))


def q_batch_center(spark, d):
    c1 = FX.c1_orders(spark, d)
    filled = P.fill_bad(P.log2_normalize(c1, FX.C1_FEATURES), FX.C1_FEATURES)
    return rounded(P.batch_center(filled, FX.C1_FEATURES, "batch"))


def q_batch_center_many(spark, d):
    """T4 with as many batches as customers."""
    c1 = FX.c1_orders(spark, d, batch="o_custkey")
    filled = P.fill_bad(P.log2_normalize(c1, FX.C1_FEATURES), FX.C1_FEATURES)
    return rounded(P.batch_center(filled, FX.C1_FEATURES, "batch"))


def q_batch_correct(spark, d):
    """T5: the batches come in a table of their own."""
    c1 = FX.c1_orders(spark, d)
    filled = P.fill_bad(P.log2_normalize(c1, FX.C1_FEATURES), FX.C1_FEATURES)
    corrected = P.correct_batches(filled.drop("batch"), FX.C1_FEATURES, filled.select("patient_id", "batch"))
    return rounded(corrected.select("patient_id", *FX.C1_FEATURES))


def q_csv_scan(spark, d):
    """S1 + S2: a CSV with missing markers, read and coerced."""
    return rounded(coerce(FX.csv_orders(spark, d)))


def q_csv_violations(spark, d):
    """S1 + S3: only real failures of the CSV; missing markers are none."""
    return violations(FX.csv_orders(spark, d))


def q_standard_scale(spark, d):
    c3 = FX.c3_documents(spark, d)
    return rounded(P.StandardScaler(FX.C3_FEATURES).fit(c3).transform(c3))


def q_impute_median(spark, d):
    c1 = FX.c1_orders(spark, d)
    return rounded(P.MedianImputer(FX.C1_FEATURES).fit(c1).transform(c1))


def q_oversample(spark, d):
    return rounded(P.oversample(FX.c2_embeddings(spark, d), "response", "patient_id", 42))


def q_oversample_weights(spark, d):
    """T8 as multiplicities: how often the resampled table holds each row."""
    return P.resample_weights(FX.c2_embeddings(spark, d), "oversampling", "response", "patient_id", 42).select("patient_id", "weight")


def q_wide_moments(spark, d):
    """A2, A4 on 2,080 columns in blocks."""
    return rounded(B.wide_moments(FX.c6_products(spark, d)))


def q_wide_anova(spark, d):
    """F1 on 2,080 columns in blocks."""
    return rounded(B.wide_anova(FX.c6_products(spark, d), "response"))


def q_wide_quartiles(spark, d):
    """A5, A6 on 2,080 columns in blocks, by radix selection."""
    q = B.wide_quantiles(FX.c6_products(spark, d).persist(), [0.25, 0.5, 0.75])
    return rounded(q.groupBy("feature").agg(*(F.max(F.when(F.col("q") == p, F.col("value"))).alias(n) for p, n in ((0.25, "q1"), (0.5, "median"), (0.75, "q3")))))


def q_wide_prepared(spark, d):
    """T1-T4, T6 on 2,080 columns in blocks: every column of the prepared matrix in figures that depend on all its cells."""
    out, _ = B.prepare_wide(FX.c6_products(spark, d).persist(), "batch")
    v = F.col("value")
    return rounded(out.long().groupBy("feature").agg(F.count(v).alias("n"), F.avg(F.abs(v)).alias("mean_size"), F.min(v).alias("least"), F.max(v).alias("most"),
                                                     F.sum(v * (F.col("patient_id") % 7 - 3)).alias("by_row")))


def q_multi_fit_lr(spark, d):
    """24 candidates (3 sets of training rows, 4 strengths, 2 numbers of features) fitted together, and
    whether the gradient of each one's objective vanishes at its coefficients."""
    from cohort_engine.plans.multi_fit import Candidate, fit_table, multi_fit_lr
    df, kept = _c5_stored(spark, d)
    preparer = Preparer(kept)
    _, prepared = preparer.fit(df)
    order = S.anova_ranking(prepared, kept)
    drawn = P.resample_weights(prepared, "oversampling", "response", "patient_id", 42)
    dealt = stratified_folds(drawn, "response", "patient_id", k=5, seed=42)
    own = F.array(*((F.col("weight") * (F.col("fold") != f).cast("int")).cast("double") for f in (0, 1, 5)))
    rows = dealt.select(F.col("response").cast("double").alias("label"), F.array(*order).alias("x"), own.alias("w")).persist()
    fits = multi_fit_lr(rows, [Candidate(c, k, g) for g in range(3) for c in (0.01, 0.1, 1.0, 10.0) for k in (3, 5)])
    table = fit_table(rows, fits).select("candidate", "c", "k", "fold", "n_rows", (F.col("worst") <= 1e-7).alias("optimal")).checkpoint()
    rows.unpersist()
    preparer.release()
    df.unpersist()
    return table


def q_search_ledger(spark, d):
    """A nested search whose splits are kept; started again, it fits nothing."""
    import uuid

    from cohort_engine.plans.ledger import SearchLedger
    from cohort_engine.plans import tuning as TU
    df, kept = _c5_features(spark, d)
    cfg = TU.SearchConfig(algorithm="logistic_regression", outer_folds=2, inner_folds=2, grid=[{"C": c, "penalty": "l2", "k": k} for c, k in ((0.1, 3), (1, 3), (1, 5))])
    ledger = SearchLedger(spark, f"{ensure_checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}")
    TU.nested_cv(df, kept, cfg, 42, ledger)
    before = ledger.scores().checkpoint()
    TU.nested_cv(df, kept, cfg, 42, ledger)
    again = before.join(ledger.scores(), ["seed", "outer", "inner", "candidate", "params", "mcc", "f1", "n_rows"], "left_anti").count()
    left = sum(ledger.missing(42, o, 2, 3).count() for o in range(2))
    return before.select("outer", "inner", "candidate", "n_rows", F.lit(again + left).cast("long").alias("fitted_again"))


def q_lasso_path(spark, d):
    """weights for every strength, on all rows and with each of three folds left out, from one pass of sums; and whether
    they meet the conditions of the minimum."""
    from cohort_engine.plans.lasso_path import lasso_path, optimality
    from cohort_engine.plans.models import LASSO_ALPHAS
    df, kept = _c5_stored(spark, d)
    preparer = Preparer(kept)
    _, prepared = preparer.fit(df)
    dealt = stratified_folds(prepared, "response", "patient_id", k=3, seed=42).select("response", "fold", *kept).persist()
    path = lasso_path(dealt, kept, "response", LASSO_ALPHAS, "fold", folds=range(3))
    table = optimality(dealt, kept, "response", path, "fold").select("fold", "alpha", "n_rows", (F.col("worst") <= 1e-8).alias("optimal")).checkpoint()
    dealt.unpersist()
    preparer.release()
    df.unpersist()
    return table


def q_newton_first_tree(spark, d):
    """Gains, cuts and leaf weights of the first second-order tree (depth 2) at given cut points."""
    from cohort_engine.plans.newton_boost import fit_newton
    cuts = {"age": range(10, 120, 10), "qty": range(10, 300, 10), "tax": (0.005, 0.015, 0.025, 0.035, 0.045, 0.055, 0.065, 0.075)}
    model = fit_newton(FX.c5_signal(spark, d), list(cuts), "response", trees=1, depth=2, rate=0.1, cuts=[np.array(list(c), float) for c in cuts.values()])
    return rounded(spark.createDataFrame(model.table(), "tree int, node int, feature string, cut double, gain double, weight double, cover double"))


def q_project_features(spark, d):
    """The selected features and the keys."""
    return rounded(C.select_features(FX.c1_orders(spark, d), ["qty", "disc"], keep=["patient_id", "response", "not_there"]))


def q_top_features(spark, d):
    """The ten largest importances, here those of the class means' distance in the embedding cohort."""
    from cohort_engine.operators.explain import top_features
    per = A.moments(FX.c2_embeddings(spark, d), FX.C2_FEATURES, ["response"])
    apart = per.groupBy("feature").agg(F.abs(F.max(F.when(F.col("response") == 1, F.col("mean"))) - F.max(F.when(F.col("response") == 0, F.col("mean")))).alias("importance"))
    return rounded(top_features(apart))


def q_undersample(spark, d):
    return rounded(P.undersample(FX.c5_signal(spark, d), "response", "patient_id", 42))


def q_outliers_iqr(spark, d):
    return rounded(O.iqr_report(FX.c2_embeddings(spark, d), FX.C2_FEATURES))


def q_outliers_zscore(spark, d):
    z = P.zscore_normalize(FX.c2_embeddings(spark, d), FX.C2_FEATURES)
    return rounded(O.zscore_report(z, FX.C2_FEATURES))


def q_anova_c3(spark, d):
    return rounded(S.anova_f(FX.c3_documents(spark, d), FX.C3_FEATURES, "response"))


def q_mutual_info(spark, d):
    from cohort_engine.operators.mutual_info import mutual_info
    return rounded(mutual_info(FX.c3_documents(spark, d), FX.C3_FEATURES, "response", "patient_id"))


def q_folds(spark, d):
    return stratified_folds(FX.c5_signal(spark, d).select("patient_id", "response"),
                            "response", "patient_id", k=10, seed=42)


def _c4_folds(spark, d):
    return stratified_folds(FX.c4_scores(spark, d), "label", "patient_id", k=10, seed=42)


def q_confusion(spark, d):
    return M.confusion(FX.c4_scores(spark, d), "label", "prediction")


def q_class_scores(spark, d):
    return rounded(M.classification_scores(FX.c4_scores(spark, d), "label", "prediction"))


def q_roc_auc(spark, d):
    return rounded(M.roc_auc(FX.c4_scores(spark, d), "label", "score"))


def q_pr_curve(spark, d):
    return rounded(M.pr_curve(FX.c4_scores(spark, d), "label", "score"))


def q_aupr(spark, d):
    return rounded(M.aupr(FX.c4_scores(spark, d), "label", "score"))


def q_fold_metrics(spark, d):
    return rounded(M.binary_summary(_c4_folds(spark, d), "label", "prediction", "score", ["fold"]))


def q_fold_summary(spark, d):
    """A7 + M8: mean / population std of per-fold MCC, pooled F1 and AUC."""
    df = _c4_folds(spark, d)
    per_fold = M.binary_summary(df, "label", "prediction", "score", ["fold"])
    ms = A.mean_std(per_fold, ["mcc"])
    pooled = M.binary_summary(df, "label", "prediction", "score").select(
        F.col("f1_weighted").alias("cv_f1"), F.col("auc").alias("cv_auc"))
    return rounded(ms.select(F.col("mcc_mean").alias("cv_mcc"), F.col("mcc_std").alias("cv_mcc_std"))
                   .crossJoin(pooled))


def q_sample_rows(spark, d):
    from cohort_engine.operators.explain import sample_rows
    return rounded(sample_rows(FX.c1_orders(spark, d), "patient_id", n=100, seed=42))


def q_permute(spark, d):
    from cohort_engine.operators.explain import permute_column
    c5 = FX.c5_signal(spark, d).select("patient_id", "response", "qty")
    return rounded(permute_column(c5, "qty", "patient_id", seed=42, repeat=0))


# ---------------------------------------------------------------------------
# ---------------------------------------------------------------------------

def _c5_features(spark, d):
    df = FX.c5_signal(spark, d)
    enc = C.encode_sex(df)
    _, kept, _ = C.drop_constant(enc, cohort_features(enc))
    return df, kept


def _c5_stored(spark, d):
    """The C5 cohort, persisted before its first pass, and its features; the caller releases it."""
    df = FX.c5_signal(spark, d).persist(StorageLevel.MEMORY_AND_DISK)
    enc = C.encode_sex(df)
    _, kept, _ = C.drop_constant(enc, cohort_features(enc))
    return df, kept


def _fit(spark, d, algorithm, params):
    from cohort_engine.plans.tuning import SearchConfig, refit
    df, kept = _c5_features(spark, d)
    pipe = refit(df, kept, params, SearchConfig(algorithm=algorithm), "oversampling", 42)
    return df, pipe


RF_PARAMS = {"n_estimators": 20, "max_depth": 5, "k": 5}
LR_PARAMS = {"C": 1, "penalty": "l2", "k": 5}
GBT_PARAMS = {"n_estimators": 10, "max_depth": 3, "learning_rate": 0.1, "k": 5}


def _additivity(shap: DataFrame) -> DataFrame:
    """How many rows are explained, and of how many base + sum(phi) misses the model's output."""
    rows = shap.groupBy("patient_id").agg(F.abs(F.first("base") + F.sum("phi") - F.first("fx")).alias("miss"))
    return rows.agg(F.count("*").alias("n_rows"), F.sum((F.col("miss") > 1e-9).cast("long")).alias("n_off"))


def q_tree_shap_additivity(spark, d):
    """I6 on all rows: boosted trees."""
    from cohort_engine.operators.shap import tree_shap
    df, pipe = _fit(spark, d, "xgboost", GBT_PARAMS)
    return _additivity(tree_shap(pipe, df, n_rows=None))


def q_linear_shap_additivity(spark, d):
    """I7 on all rows: a linear SVM."""
    from cohort_engine.operators.shap import linear_shap
    df, pipe = _fit(spark, d, "svm", {"C": 1, "kernel": "linear", "k": 5})
    return _additivity(linear_shap(pipe, df, n_rows=None))


def q_ice_layout(spark, d):
    """I3 on all rows: how many curves and points each feature gets."""
    from cohort_engine.operators.explain import ice_curves
    df, pipe = _fit(spark, d, "logistic_regression", LR_PARAMS)
    curves = ice_curves(pipe, df, features=["qty", "sex", "disc"])
    return curves.groupBy("feature").agg(F.count_distinct("patient_id").alias("n_curves"), F.count_distinct("grid_value").alias("n_points"),
                                         F.count("p1").alias("n_cells"))


def q_svm_classes(spark, d):
    """The size of each estimator's prediction table on all rows, and rows whose class is not the side of its own rule."""
    out = None
    for algorithm, params in (("svm", {"C": 1, "kernel": "linear", "k": 5}), ("svm", {"C": 1, "kernel": "rbf", "k": 5}),
                              ("cart", {"max_depth": 10, "min_samples_split": 2, "k": 5})):
        df, pipe = _fit(spark, d, algorithm, params)
        assembled = pipe.assemble(df)
        scored = pipe.model.transform(assembled)
        own = pipe.model.rule(assembled)
        part = scored.join(own, "patient_id").agg(F.count("*").alias("n_rows"), F.sum((F.col("prediction") != F.col("own")).cast("long")).alias("n_off"))
        part = part.select(F.lit(params.get("kernel", algorithm)).alias("estimator"), "n_rows", "n_off")
        out = part if out is None else out.unionByName(part)
    return out


def q_oof_layout(spark, d):
    """The out-of-fold table holds every row once, in its own fold."""
    from cohort_engine.plans.tuning import SearchConfig, nested_cv
    df, kept = _c5_features(spark, d)
    cfg = SearchConfig(algorithm="logistic_regression", outer_folds=3, inner_folds=2, grid=[{"C": 1, "penalty": "l2", "k": 3}])
    oof = nested_cv(df, kept, cfg, 42)["oof"]
    return oof.select("patient_id", F.col("label").alias("response"), "fold")


def q_model_selection(spark, d):
    """G3-G8 + M8: nested stratified CV of logistic regression on C5 (3 outer, 2
    inner folds, a 2 x 2 grid), summarised per seed."""
    from cohort_engine.plans.tuning import SearchConfig, decide_resampling, grid_search, nested_cv, refit, seed_summary
    df, kept = _c5_features(spark, d)
    cfg = SearchConfig(algorithm="logistic_regression", outer_folds=3, inner_folds=2,
                       grid=[{"C": c, "penalty": "l2", "k": k} for c in (0.1, 1) for k in (3, 5)])
    res = nested_cv(df, kept, cfg, 42)
    strategy = decide_resampling(df, cfg)
    pipe = refit(df, kept, grid_search(df, kept, cfg, strategy, 42)["best"], cfg, strategy, 42)
    return rounded(seed_summary(res, 42, len(pipe.features)))


def q_evaluate_holdout(spark, d):
    """M9: a forest trained on four of five stratified folds, scored on the fifth."""
    from cohort_engine.plans.train import evaluate_independent
    from cohort_engine.plans.tuning import SearchConfig, refit
    df, kept = _c5_features(spark, d)
    folds = stratified_folds(df, "response", "patient_id", k=5, seed=7)
    train, test = folds.where("fold <> 0").drop("fold"), folds.where("fold = 0").drop("fold")
    pipe = refit(train, kept, RF_PARAMS, SearchConfig(algorithm="random_forest"), "oversampling", 42)
    return rounded(evaluate_independent(pipe, test)["metrics"])


def q_tree_shap(spark, d):
    from cohort_engine.operators.shap import tree_shap
    df, pipe = _fit(spark, d, "random_forest", RF_PARAMS)
    return rounded(tree_shap(pipe, df))


def q_gbt_shap_summary(spark, d):
    from cohort_engine.operators.shap import shap_summary, tree_shap
    df, pipe = _fit(spark, d, "xgboost", GBT_PARAMS)
    return rounded(shap_summary(tree_shap(pipe, df)))


def q_linear_shap(spark, d):
    from cohort_engine.operators.shap import linear_shap
    df, pipe = _fit(spark, d, "logistic_regression", LR_PARAMS)
    return rounded(linear_shap(pipe, df))


def q_model_importance(spark, d):
    from cohort_engine.operators.explain import model_importance, top_features
    _, pipe = _fit(spark, d, "random_forest", RF_PARAMS)
    return rounded(top_features(model_importance(pipe)))


def q_permutation_importance(spark, d):
    from cohort_engine.operators.explain import permutation_importance, top_features
    df, pipe = _fit(spark, d, "logistic_regression", LR_PARAMS)
    return rounded(top_features(permutation_importance(pipe, df), "importance_mean"))


def q_drop_column_importance(spark, d):
    from cohort_engine.operators.explain import drop_column_importance
    df, pipe = _fit(spark, d, "logistic_regression", LR_PARAMS)
    return rounded(drop_column_importance(pipe, df))


def q_ice_curves(spark, d):
    from cohort_engine.operators.explain import ice_curves
    df, pipe = _fit(spark, d, "logistic_regression", LR_PARAMS)
    return ice_curves(pipe, df, digits=DIGITS)


def q_lasso_select(spark, d):
    from cohort_engine.plans.pipeline_prep import Preparer
    df, kept = _c5_stored(spark, d)
    preparer = Preparer(kept)
    _, prepared = preparer.fit(df)
    chosen = S.lasso_select(prepared, kept, "response", alpha=0.01)
    preparer.release()
    df.unpersist()
    return spark.createDataFrame([(f, f in chosen) for f in kept], "feature string, selected boolean")


def q_rfe_ranking(spark, d):
    from cohort_engine.plans.pipeline_prep import Preparer
    df, kept = _c5_stored(spark, d)
    preparer = Preparer(kept, keep=False)            # RFE reads the prepared rows once
    _, prepared = preparer.fit(df)
    order = S.rfe_path(prepared, kept, "response")
    preparer.release()
    df.unpersist()
    return spark.createDataFrame([(f, i + 1) for i, f in enumerate(order)], "feature string, position int")


def q_isolation_forest(spark, d):
    from cohort_engine.operators.isoforest import isolation_report
    return rounded(isolation_report(FX.c2_embeddings(spark, d), FX.C2_FEATURES))


def q_pca_outliers(spark, d):
    z = P.zscore_normalize(FX.c2_embeddings(spark, d), FX.C2_FEATURES)
    return rounded(O.pca_report(z, FX.C2_FEATURES, threshold=0.3, n_components=3))


ROWS_ONLY = ("model_selection", "evaluate_holdout", "tree_shap", "gbt_shap_summary", "linear_shap",
             "model_importance", "permutation_importance", "drop_column_importance", "ice_curves",
             "lasso_select", "rfe_ranking", "isolation_forest", "pca_outliers")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship_anova_topk": flagship,
    "c1_cohort": q_c1_cohort,
    "c3_cohort": q_c3_cohort,
    "c2_cohort": q_c2_cohort,
    "c4_scores": q_c4_scores,
    "c5_cohort": q_c5_cohort,
    "anova_topk_c2": q_anova_topk_c2,
    "mutual_info_c2": q_mutual_info_c2,
    "dirty_violations": q_dirty_violations,
    "dirty_coerced": q_dirty_coerced,
    "cohort_union": q_cohort_union,
    "constant_columns": q_constant_columns,
    "align_columns": q_align_columns,
    "class_balance": q_class_balance,
    "feature_ranges": q_feature_ranges,
    "any_negative": q_any_negative,
    "moments": q_moments,
    "medians": q_medians,
    "quartiles": q_quartiles,
    "log2_normalize": q_log2,
    "zscore_normalize": q_zscore,
    "fill_bad": q_fill_bad,
    "batch_center": q_batch_center,
    "batch_center_many": q_batch_center_many,
    "batch_correct": q_batch_correct,
    "csv_scan": q_csv_scan,
    "csv_violations": q_csv_violations,
    "tree_shap_additivity": q_tree_shap_additivity,
    "linear_shap_additivity": q_linear_shap_additivity,
    "ice_layout": q_ice_layout,
    "svm_classes": q_svm_classes,
    "oof_layout": q_oof_layout,
    "standard_scale": q_standard_scale,
    "impute_median": q_impute_median,
    "oversample": q_oversample,
    "oversample_weights": q_oversample_weights,
    "wide_moments": q_wide_moments,
    "wide_anova": q_wide_anova,
    "wide_quartiles": q_wide_quartiles,
    "wide_prepared": q_wide_prepared,
    "multi_fit_lr": q_multi_fit_lr,
    "search_ledger": q_search_ledger,
    "lasso_path": q_lasso_path,
    "newton_first_tree": q_newton_first_tree,
    "project_features": q_project_features,
    "top_features": q_top_features,
    "undersample": q_undersample,
    "outliers_iqr": q_outliers_iqr,
    "outliers_zscore": q_outliers_zscore,
    "anova_scores": q_anova_c3,
    "mutual_info": q_mutual_info,
    "stratified_folds": q_folds,
    "confusion": q_confusion,
    "class_scores": q_class_scores,
    "roc_auc": q_roc_auc,
    "pr_curve": q_pr_curve,
    "aupr": q_aupr,
    "fold_metrics": q_fold_metrics,
    "fold_summary": q_fold_summary,
    "sample_rows": q_sample_rows,
    "permute_column": q_permute,
    "model_selection": q_model_selection,
    "evaluate_holdout": q_evaluate_holdout,
    "tree_shap": q_tree_shap,
    "gbt_shap_summary": q_gbt_shap_summary,
    "linear_shap": q_linear_shap,
    "model_importance": q_model_importance,
    "permutation_importance": q_permutation_importance,
    "drop_column_importance": q_drop_column_importance,
    "ice_curves": q_ice_curves,
    "lasso_select": q_lasso_select,
    "rfe_ranking": q_rfe_ranking,
    "isolation_forest": q_isolation_forest,
    "pca_outliers": q_pca_outliers,
}


def _shipped(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        ensure_checkpoint_dir(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    return _shipped(flagship)(spark, SMOKE_DIR)


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and twins of the training-data subpackage and the pipeline, where they are present."""
    if importlib.util.find_spec("cohort_engine.llm") is None:
        return {}, {}
    from cohort_engine.llm.queries import ORACLE, QUERIES
    fns, twins = dict(QUERIES), dict(ORACLE)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline
        fns["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL:
            twins["pipeline"] = corpus_pipeline.ORACLE_SQL
    return fns, twins


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _shipped(fn) for name, fn in (_QUERIES | _llm()[0]).items()}


def oracle_sql() -> dict[str, str]:
    from oracle_twins import ORACLE
    return {k: v for k, v in ORACLE.items() if k in _QUERIES} | _llm()[1]
