"""Mutual information against an O(n^2) numpy brute force."""

import numpy as np

from cohort_engine.functions.digamma import digamma_exact
from cohort_engine.operators.mutual_info import mutual_info


def brute_mi(x, y, k=3):
    n = len(x)
    keep = np.array([np.sum(y == y[i]) > 1 for i in range(n)])
    x, y = x[keep], y[keep]
    n = len(x)
    ks, ncs, ms = [], [], []
    for i in range(n):
        same = np.where((y == y[i]) & (np.arange(n) != i))[0]
        kk = min(k, len(same))
        r = np.sort(np.abs(x[same] - x[i]))[kk - 1]
        d = np.abs(x - x[i])
        m = np.sum(d < r) if r > 0 else np.sum(d == 0)
        ks.append(kk)
        ncs.append(len(same) + 1)
        ms.append(m)
    psi = digamma_exact
    return max(0.0, psi(n) + np.mean([psi(v) for v in ks]) - np.mean([psi(v) for v in ncs])
               - np.mean([psi(v) for v in ms]))


def test_mi_matches_brute_force(spark):
    rng = np.random.default_rng(7)
    n = 300
    y = rng.integers(0, 2, n)
    a = np.round(rng.normal(y * 0.8, 1.0), 1)          # ties on purpose
    b = rng.normal(0, 1, n)
    rows = [(int(i), int(y[i]), float(a[i]), float(b[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "patient_id long, response int, a double, b double")
    got = {r.feature: r.mi for r in mutual_info(df, ["a", "b"]).collect()}
    assert abs(got["a"] - brute_mi(a, y)) < 1e-9
    assert abs(got["b"] - brute_mi(b, y)) < 1e-9


def test_mi_with_repeated_ids(spark):
    """Resampled copies share an id but are separate points (distance 0 apart)."""
    rng = np.random.default_rng(11)
    n = 200
    y = rng.integers(0, 2, n)
    a = rng.normal(y * 2.0, 1.0)
    rows = [(int(i), int(y[i]), float(a[i])) for i in range(n)]
    rows += [rows[i] for i in range(0, n, 4)]                # 50 copies with repeated ids
    df = spark.createDataFrame(rows, "patient_id long, response int, a double")
    got = mutual_info(df, ["a"]).first().mi
    ys = np.array([r[1] for r in rows])
    xs = np.array([r[2] for r in rows])
    want = brute_mi(xs, ys)
    assert want > 0.1 and abs(got - want) < 1e-9


def test_mi_with_hot_value(spark):
    """A value held by 40 % of the rows (both classes) is one pre-aggregated row."""
    rng = np.random.default_rng(5)
    n = 400
    y = rng.integers(0, 2, n)
    a = np.where(rng.random(n) < 0.4, 0.0, np.round(rng.normal(y * 1.5, 1.0), 2))
    rows = [(int(i), int(y[i]), float(a[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "patient_id long, response int, a double")
    got = mutual_info(df, ["a"]).first().mi
    assert abs(got - brute_mi(a, y)) < 1e-9


def test_mi_shuffles_no_row_for_every_neighbour(spark, monkeypatch):
    """neighbours come from the sorted buckets; only what lies at bucket edges is joined by rank.

    More buckets than values, so that neighbours lie several buckets away."""
    from cohort_engine.operators import mutual_info as M
    rng = np.random.default_rng(3)
    n = 600
    y = rng.integers(0, 2, n)
    a, b = np.round(64 * rng.normal(y, 1.0)) / 64, rng.exponential(1.0, n) ** 5        # exact differences
    df = spark.createDataFrame([(int(i), int(y[i]), float(a[i]), float(b[i])) for i in range(n)], "patient_id long, response int, a double, b double")
    ran, running_sum = [], M.running_sum
    monkeypatch.setattr(M, "running_sum", lambda df, *args, **kw: ran.append(df.columns) or running_sum(df, *args, **kw))
    for buckets in (3, 300):
        with monkeypatch.context() as m:
            m.setattr("cohort_engine.functions.cumulative.bucket_count", lambda spark, rows, k=buckets: k)
            got = {r.feature: r.mi for r in mutual_info(df, ["a", "b"]).collect()}
        assert abs(got["a"] - brute_mi(a, y)) < 1e-9 and abs(got["b"] - brute_mi(b, y)) < 1e-9
    assert {"__at-3", "__at-1", "__at1", "__at3"} <= set(ran[0])
