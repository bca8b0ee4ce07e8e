"""Scoring-side behaviour: fitted statistics and column alignment."""

from pyspark.sql import functions as F

from cohort_engine.plans.pipeline_prep import Preparer
from cohort_engine.plans.train import evaluate_independent
from cohort_engine.plans.tuning import SearchConfig, refit
from cohort_engine.sources import fixtures as FX

from conftest import SF_SMALL

FEATS = ["age", "totalprice", "qty", "price", "disc", "tax"]


def test_fit_statistics_make_rows_independent(spark):
    df = FX.c2_embeddings(spark, SF_SMALL)            # negatives -> z-score branch
    cols = FX.C2_FEATURES[:5]
    model, _ = Preparer(cols, batch_col=None, stats="fit").fit(df)
    whole = {r.patient_id: r for r in model.transform(df).collect()}
    one_id = sorted(whole)[7]
    alone = model.transform(df.where(F.col("patient_id") == one_id)).first()
    for c in cols:
        assert abs(alone[c] - whole[one_id][c]) < 1e-12
    # the default own-frame scope depends on the companions (reference behaviour)
    own, _ = Preparer(cols, batch_col=None, stats="self").fit(df)
    pair = own.transform(df.where(F.col("patient_id").isin(sorted(whole)[:2])))
    assert pair.count() == 2


def test_evaluate_aligns_missing_columns(spark):
    df = FX.c5_signal(spark, SF_SMALL)
    pipe = refit(df, FEATS, {"C": 1, "penalty": "l2", "k": 6}, SearchConfig(algorithm="logistic_regression"),
                 "oversampling", 42)
    renamed = df.drop("disc").toDF(*[c.upper() for c in df.drop("disc").columns])
    ev = evaluate_independent(pipe, renamed, "RESPONSE")
    m = ev["metrics"].first()
    assert m.n == df.count() and 0.0 <= m.accuracy <= 1.0
