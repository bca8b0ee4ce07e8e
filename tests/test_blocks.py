"""Column-block matrices against numpy: statistics, quantiles, transforms, wide CSV, 20,000 columns."""

import numpy as np
import pandas as pd
import pytest

from cohort_engine.operators import blocks as B
from cohort_engine.operators import prep as P
from cohort_engine.operators import select as S


def matrix(spark, x, labels=None, batches=None, width=4, parts=3):
    n = len(x)
    rows = [(i, None if labels is None else int(labels[i]), None if batches is None else batches[i], [None if v != v else float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "patient_id long, response int, batch double, x array<double>").repartition(parts)
    return B.from_arrays(df, ["patient_id", "response", "batch"], "x", [f"m{j}" for j in range(x.shape[1])], width)


def back(m, n, p):
    out = np.full((n, p), np.nan)
    at = {c: j for j, c in enumerate(m.columns)}
    for r in m.long().collect():
        out[r.patient_id, at[r.feature]] = np.nan if r.value is None else r.value
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 11)) * np.logspace(-3, 6, 11) + 1e3 * (np.arange(11) % 3 == 0)
    x[rng.random(x.shape) < 0.15] = np.nan
    x[:, 4], x[:, 7] = np.nan, 2.5
    return x


def test_moments_constant_and_anova(spark, data):
    labels = np.arange(60) % 2
    m = matrix(spark, data, labels)
    got = {r.feature: r for r in B.wide_moments(m).collect()}
    for j in range(11):
        own, r = data[:, j][~np.isnan(data[:, j])], got[f"m{j}"]
        assert r.n == len(own)
        if len(own):
            assert np.allclose([r.mean, r.std_pop, r.min_value, r.max_value], [own.mean(), own.std(), own.min(), own.max()], rtol=1e-9)
        else:
            assert r.mean is None and r.std_pop is None and r.min_value is None
    assert {r.feature for r in B.wide_constant(m).collect() if r.is_constant} == {"m4", "m7"}
    cols = m.columns
    flat = spark.createDataFrame([(int(labels[i]), *[None if v != v else float(v) for v in data[i]]) for i in range(60)], "response int, " + ", ".join(f"{c} double" for c in cols))
    want = {r.feature: r.f_score for r in S.anova_f(flat, cols).collect()}
    for r in B.wide_anova(m, "response").collect():
        assert r.f_score == want[r.feature] or np.isclose(r.f_score, want[r.feature], rtol=1e-4)        # m0: spread 1e-6 of its mean


@pytest.mark.parametrize("gather", [2048, 5, 0])
def test_quantiles_by_radix_selection(spark, data, gather):
    x = np.concatenate([data, np.tile(np.array([0.0, -0.0, -3.0, 1e300, 5e-324, 7, 7, 2.5, -1e-300, 4, -4]), (40, 1))])
    got = {(r.feature, r.q): r.value for r in B.wide_quantiles(matrix(spark, x), [0.25, 0.5, 1.0], gather).collect()}
    for j in range(11):
        own = x[:, j][~np.isnan(x[:, j])]
        for q in (0.25, 0.5, 1.0):
            assert np.isclose(got[f"m{j}", q], np.quantile(own, q), rtol=1e-12)
    empty = B.wide_quantiles(matrix(spark, np.full((3, 2), np.nan)), [0.5]).collect()
    assert [r.value for r in empty] == [None, None]


@pytest.mark.parametrize("positive", [True, False])
def test_preparation_is_that_of_the_column_form(spark, data, positive):
    x = np.abs(data) if positive else data
    x = x[:, [0, 1, 2, 3, 5, 6, 7, 8]]
    batches = [None if i % 7 == 0 else float(i % 3) for i in range(60)]
    m = matrix(spark, x, np.arange(60) % 2, batches)
    got, facts = B.prepare_wide(m, "batch")
    cols = m.columns
    flat = spark.createDataFrame([(i, i % 2, batches[i], *[None if v != v else float(v) for v in x[i]]) for i in range(60)],
                                 "patient_id long, response int, batch double, " + ", ".join(f"{c} double" for c in cols))
    from cohort_engine.plans.pipeline_prep import Preparer
    preparer = Preparer(cols)
    _, want = preparer.fit(flat)
    want = want.toPandas().sort_values("patient_id")[cols].to_numpy(float)
    assert facts.zscore is not positive
    assert np.allclose(back(got, 60, len(cols)), want, rtol=1e-5, atol=1e-5)        # m0: spread 1e-6 of its mean
    preparer.release()


def test_imputation_and_columns(spark, data):
    m = matrix(spark, data)
    filled = back(B.impute_wide(m), 60, 11)
    med = np.array([np.nanmedian(data[:, j]) if j != 4 else np.nan for j in range(11)])
    assert np.allclose(filled, np.where(np.isnan(data), med, data), equal_nan=True)
    df = spark.createDataFrame([(1, 1.0, float("nan"), float("inf")), (2, None, 3.0, 4.0)], "id long, `a b` double, c float, d double")
    got = {(r.id, r.feature): r.value for r in B.from_columns(df, ["id"], ["a b", "c", "d"], 2).long().collect()}
    assert got == {(1, "a b"): 1.0, (1, "c"): None, (1, "d"): None, (2, "a b"): None, (2, "c"): 3.0, (2, "d"): 4.0}


def test_accumulators_are_passed_on_when_they_grow(spark, data, monkeypatch):
    m = matrix(spark, data, np.arange(60) % 2)
    want = {r.feature: (r.n, r.mean) for r in B.wide_moments(m).collect()}
    monkeypatch.setattr(B, "HELD_BYTES", 1)
    got = {r.feature: (r.n, r.mean) for r in B.wide_moments(m).collect()}
    assert all(got[c][0] == want[c][0] and (want[c][1] is None or np.isclose(got[c][1], want[c][1])) for c in want)


def test_empty_matrix(spark):
    m = matrix(spark, np.zeros((1, 3)))
    none = B.BlockMatrix(m.rows.limit(0), m.keys, m.columns, m.width)
    assert B.wide_moments(none).count() == 0 and not B.wide_any_negative(none)
    assert [r.value for r in B.wide_quantiles(none, [0.5]).collect()] == [None] * 3
    assert {r.f_score for r in B.wide_anova(none, "response").collect()} == {None}


def test_twenty_thousand_columns_from_csv(spark, tmp_path):
    p, n = 20_000, 24
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=(n, p)), 4)
    x[12:, 7777] += 50
    text = "Patient_ID,response," + ",".join(f"M{j}" for j in range(p)) + "\n"
    for i in range(n):
        cells = [str(v) for v in x[i]]
        cells[5] = "NA" if i == 3 else "n/a" if i == 4 else "abc" if i == 5 else cells[5]
        text += f"s{i},{int(i >= 12)}," + ",".join(cells) + "\n"
    path = tmp_path / "wide.csv"
    path.write_text(text)
    m = B.read_block_csv(spark, str(path), ["patient_id", "response"]).persist()
    assert m.columns[:2] == ["m0", "m1"] and len(m.columns) == p
    stats = B.wide_moments(m).toPandas().set_index("feature")
    assert np.allclose(stats.loc["m6", ["mean", "std_pop"]].to_numpy(float), [x[:, 6].mean(), x[:, 6].std()])
    assert len(stats) == p and stats.loc["m5", "n"] == n - 3
    best = B.wide_anova(m, "response").orderBy("f_score", ascending=False).first()
    assert best.feature == "m7777"
    out, facts = B.prepare_wide(m)
    assert facts.zscore
    after = B.wide_moments(out).toPandas()
    assert np.allclose(after["mean"], 0, atol=1e-9) and np.allclose(after["std_pop"], 1)
    m.rows.unpersist()
