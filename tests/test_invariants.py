"""Invariants of the operators on the fixture cohorts (sf0.001)."""

from pyspark.sql import functions as F

from cohort_engine.operators import metrics as M
from cohort_engine.operators import prep as P
from cohort_engine.plans.folds import stratified_folds
from cohort_engine.sources import fixtures as FX

from conftest import SF_SMALL


def test_fold_sizes_balanced_per_class(spark):
    c5 = FX.c5_signal(spark, SF_SMALL)
    f = stratified_folds(c5, "response", "patient_id", k=10, seed=42)
    sizes = f.groupBy("response", "fold").count().toPandas()
    for _, g in sizes.groupby("response"):
        assert g["count"].max() - g["count"].min() <= 1
    assert f.count() == c5.count() and f.select("patient_id").distinct().count() == c5.count()


def test_oversample_balances_and_keeps_originals(spark):
    c2 = FX.c2_embeddings(spark, SF_SMALL)
    before = {r[0]: r[1] for r in c2.groupBy("response").count().collect()}
    out = P.oversample(c2, "response", "patient_id", 42)
    after = {r[0]: r[1] for r in out.groupBy("response").count().collect()}
    assert after[0] == after[1] == max(before.values())
    assert out.join(c2.select("patient_id"), "patient_id", "left_anti").count() == 0


def test_undersample(spark):
    c5 = FX.c5_signal(spark, SF_SMALL)
    out = P.undersample(c5, "response", "patient_id", 42)
    counts = {r[0]: r[1] for r in out.groupBy("response").count().collect()}
    assert counts[0] == counts[1]


def test_batch_means_zero_after_centring(spark):
    c1 = FX.c1_orders(spark, SF_SMALL)
    filled = P.fill_bad(P.log2_normalize(c1, FX.C1_FEATURES), FX.C1_FEATURES)
    cen = P.batch_center(filled, FX.C1_FEATURES, "batch")
    row = cen.groupBy("batch").agg(F.avg("qty").alias("m"), F.avg("totalprice").alias("t")).collect()
    assert all(abs(r.m) < 1e-9 and abs(r.t) < 1e-6 for r in row)


def test_aupr_anchor_case(spark):
    rows = [(1, 0, 0.9), (2, 1, 0.9), (3, 1, 0.7), (4, 0, 0.6), (5, 1, 0.5), (6, 0, 0.4)]
    df = spark.createDataFrame(rows, "id long, label int, score double")
    assert abs(M.aupr(df).first()["aupr"] - 0.627778) < 1e-6
    # positives .9 .7 .5 vs negatives .9 .6 .4: wins 2.5 + 2 + 1 = 5.5 of 9
    assert abs(M.roc_auc(df).first()["auc"] - 5.5 / 9.0) < 1e-12


def test_confusion_zero_cells_and_mcc(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (0, 1)], "label int, prediction int")
    cm = {(r.actual, r.predicted): r.n for r in M.confusion(df).collect()}
    assert cm == {(0, 0): 0, (0, 1): 1, (1, 0): 0, (1, 1): 2}
    s = M.classification_scores(df).first()
    assert s.mcc == 0.0 and abs(s.accuracy - 2 / 3) < 1e-12


def test_permuted_copies_are_full_permutations(spark):
    from cohort_engine.operators.explain import permute_column, permuted_copies
    c5 = FX.c5_signal(spark, SF_SMALL).select("patient_id", "response", "qty", "tax")
    n = c5.count()
    cp = permuted_copies(c5, ["qty", "tax"], "patient_id", repeats=3, seed=42).persist()
    sizes = {(r["__f"], r["__rep"]): r["count"] for r in cp.groupBy("__f", "__rep").count().collect()}
    assert sizes == {(f, r): n for f in ("qty", "tax") for r in range(3)}
    orig = sorted(r.qty for r in c5.select("qty").collect())
    assert sorted(r.qty for r in cp.where("__f = 'qty' AND __rep = 1").select("qty").collect()) == orig
    # the untouched column stays with its row
    same = cp.where("__f = 'qty'").join(c5.select("patient_id", F.col("tax").alias("t0")), "patient_id")
    assert same.where("tax <> t0").count() == 0
    # copy (qty, 0) is exactly the SQL-checked single-column permutation
    one = permute_column(c5, "qty", "patient_id", seed=42, repeat=0).select("patient_id", F.col("qty").alias("q1"))
    both = cp.where("__f = 'qty' AND __rep = 0").join(one, "patient_id")
    assert both.count() == n and both.where("qty <> q1").count() == 0
