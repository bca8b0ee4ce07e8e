"""Candidates fitted together, multiplicities in place of copies, and a search taken up again."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohort_engine.operators import prep as P
from cohort_engine.operators import select as S
from cohort_engine.operators.mutual_info import mutual_info
from cohort_engine.plans import tuning as TU
from cohort_engine.plans.ledger import SearchLedger
from cohort_engine.plans.multi_fit import Candidate, fit_counts, fit_table, multi_fit_lr
from cohort_engine.sources import fixtures as FX

from conftest import SF_SMALL


def rows(spark, n=300, p=4, seed=0, parts=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) * [1, 5, 0.1, 2]
    y = (x @ [1.0, -0.4, 3.0, 0.0] + rng.normal(size=n) > 0.5).astype(int)
    w = np.stack([np.ones(n), rng.integers(0, 4, n), (np.arange(n) % 3 > 0)], axis=1).astype(float)
    df = spark.createDataFrame([(float(y[i]), list(map(float, x[i])), list(map(float, w[i]))) for i in range(n)], "label double, x array<double>, w array<double>")
    return df.repartition(parts).persist(), x, y, w


def test_every_candidate_is_optimal_and_agrees_with_the_single_fit(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    df, x, y, w = rows(spark)
    cands = [Candidate(c, k, g) for c in (0.01, 1.0, 100.0) for k in (1, 4) for g in range(3)]
    fits = multi_fit_lr(df, cands)
    table = {r.candidate: r for r in fit_table(df, fits).collect()}
    assert all(table[i].worst < 1e-7 and table[i].n_rows == w[:, c.group].sum() for i, c in enumerate(cands))
    for i in (0, 4, 17):
        c = cands[i]
        one = df.select("label", array_to_vector(F.slice("x", 1, c.k)).alias("features"), F.col("w")[c.group].alias("weight"))
        m = LogisticRegression(weightCol="weight", regParam=1 / (c.c * float(w[:, c.group].sum())), elasticNetParam=0.0, standardization=False, maxIter=500, tol=1e-10).fit(one)
        assert np.allclose(m.coefficients.toArray(), fits[i].weights, atol=2e-3) and abs(m.intercept - fits[i].intercept) < 2e-3
    counts = fit_counts(df, fits)
    want = {}
    for a, b in zip(y, x @ fits[-1].weights + fits[-1].intercept > 0):
        want[float(a), float(b)] = want.get((float(a), float(b)), 0) + 1
    assert counts[len(fits) - 1] == want
    df.unpersist()


def test_separable_empty_and_one_class(spark):
    df = spark.createDataFrame([(float(i > 4), [float(i)], [1.0, 0.0]) for i in range(10)], "label double, x array<double>, w array<double>").persist()
    fits = multi_fit_lr(df, [Candidate(1e6, 1), Candidate(1.0, 1, 1)])
    assert fits[0].weights[0] > 1 and np.isfinite(fits[0].weights).all()
    assert fits[1].weights.tolist() == [0.0] and fits[1].total == 0
    assert multi_fit_lr(df.limit(0), [Candidate(1.0, 1)])[0].weights.tolist() == [0.0]
    with pytest.raises(ValueError):
        multi_fit_lr(df, [Candidate(1.0, 513)])
    df.unpersist()


@pytest.mark.parametrize("strategy", ["oversampling", "undersampling", "none"])
def test_weights_are_the_counts_of_the_copies(spark, strategy):
    df = FX.c5_signal(spark, SF_SMALL).select("patient_id", "response", "qty", "disc").persist()
    copies = P.resample(df, strategy).groupBy("patient_id").count()
    weights = P.resample_weights(df, strategy)
    assert {(r[0], r[1]) for r in copies.collect()} == {(r.patient_id, r.weight) for r in weights.select("patient_id", "weight").collect()}
    flat = {r.feature: r.f_score for r in S.anova_f(P.resample(df, strategy), ["qty", "disc"]).collect()}
    for r in S.anova_f(weights, ["qty", "disc"], weight="weight").collect():
        assert np.isclose(r.f_score, flat[r.feature], rtol=1e-9)
    if strategy == "oversampling":
        a = {r.feature: r.mi for r in mutual_info(P.resample(df, strategy), ["qty"], "response").collect()}
        assert np.isclose(a["qty"], mutual_info(weights, ["qty"], "response", weight="weight").first().mi)
    with pytest.raises(ValueError):
        P.resample_weights(df, "sideways")
    df.unpersist()


def test_killed_search_fits_only_what_is_missing(spark, tmp_path, monkeypatch):
    df = FX.c5_signal(spark, SF_SMALL).drop("constant_col")
    feats = ["age", "totalprice", "qty", "price", "disc", "tax"]
    cfg = TU.SearchConfig(algorithm="logistic_regression", outer_folds=2, inner_folds=2, grid=[{"C": c, "penalty": "l2", "k": 3} for c in (0.1, 1)])
    ledger = SearchLedger(spark, str(tmp_path / "ledger"))
    real, calls = TU.score_candidates, []

    def counted(*args):
        calls.append(1)
        if len(calls) == 4:
            raise KeyboardInterrupt("killed")
        return real(*args)

    monkeypatch.setattr(TU, "score_candidates", counted)
    with pytest.raises(KeyboardInterrupt):
        TU.nested_cv(df, feats, cfg, 42, ledger)
    assert ledger.scores().count() == 3 * 2 and ledger.missing(42, 1, 2, 2).count() == 2 and ledger.choices().count() == 1
    res = TU.nested_cv(df, feats, cfg, 42, ledger)
    assert len(calls) == 5 and ledger.missing(42, 1, 2, 2).count() == 0 and res["oof"].count() == df.count()
    res = TU.nested_cv(df, feats, cfg, 42, ledger)
    assert len(calls) == 5 and [o for o, _ in res["chosen"]] == [0, 1]
    best = TU.grid_search(df, feats, cfg, "none", 42, ledger)["best"]
    assert len(calls) == 7 and TU.grid_search(df, feats, cfg, "none", 42, ledger)["best"] == best and len(calls) == 7
    other = TU.SearchConfig(algorithm="logistic_regression", outer_folds=2, inner_folds=2, grid=[{"C": 5, "penalty": "l2", "k": 3}] * 2)
    with pytest.raises(ValueError):
        TU.grid_search(df, feats, other, "none", 42, ledger)
    pipe = TU.refit(df, feats, best, cfg, "oversampling", 42)
    row = TU.seed_report(res, 42, cfg, pipe, ["constant_col"]).first()
    assert row.tn + row.fp + row.fn + row.tp == df.count() and len(row.features) == 3 and row.dropped_constant == ["constant_col"] and row.removed_outliers == []


def test_array_columns_reach_the_sums_as_matrices(spark):
    """No object a row between Arrow and the sums; batches that are slices keep their own rows, NULL is NaN."""
    import pyarrow as pa
    from cohort_engine.plans.multi_fit import columns_of, vector_sums
    batch = pa.RecordBatch.from_pydict({"x": [[1.0, 2.0], [3.0, None], [5.0, 6.0]], "y": [1, 0, 1]}).slice(1)
    got = columns_of(batch)
    assert isinstance(got["x"], np.ndarray) and got["x"].shape == (2, 2) and np.isnan(got["x"][0, 1]) and list(got["y"]) == [0, 1]
    rows = spark.range(1000).selectExpr("array(double(id), 1D) AS x")
    assert list(vector_sums(rows, ["x"], lambda b: {3: b["x"].sum(axis=0)})[3]) == [499500.0, 1000.0]
