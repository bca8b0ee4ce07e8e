"""Second-order boosting against a plain one, and lasso paths by their conditions and folds."""

import numpy as np
import pytest

from cohort_engine.plans.lasso_path import ALL, lasso_path, lasso_paths, optimality
from cohort_engine.plans.newton_boost import fit_newton


def plain_boost(x, y, w, cuts, trees, depth, rate, lam, gamma):
    """Row by row, every cut of every column tried."""
    margin, out = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        nodes = {}

        def grow(k, rows, left):
            nodes[k] = -g[rows].sum() / (h[rows].sum() + lam)
            best = (0.0, None)
            for j in range(x.shape[1]) if left else ():
                null = np.isnan(x[rows, j])
                for c in cuts[j]:
                    for null_left in ((True, False) if null.any() else (True,)):
                        go = np.where(null, null_left, x[rows, j] <= c)
                        a, b = rows[go], rows[~go]
                        if h[a].sum() < 1 or h[b].sum() < 1:
                            continue
                        gain = (g[a].sum() ** 2 / (h[a].sum() + lam) + g[b].sum() ** 2 / (h[b].sum() + lam) - g[rows].sum() ** 2 / (h[rows].sum() + lam)) / 2 - gamma
                        if gain > best[0] + 1e-9:
                            best = (gain, (a, b))
            if best[1] is None:
                margin[rows] += rate * nodes[k]
                return
            grow(2 * k, best[1][0], left - 1)
            grow(2 * k + 1, best[1][1], left - 1)

        grow(1, np.arange(len(y)), depth)
        out.append(nodes)
    return margin, out


@pytest.mark.parametrize("weighted", [False, True])
def test_boosting_is_the_plain_one(spark, weighted):
    rng = np.random.default_rng(5)
    n = 240
    x = np.round(rng.normal(size=(n, 3)), 1)
    x[rng.random(x.shape) < 0.1] = np.nan
    y = (np.nan_to_num(x[:, 0]) + np.nan_to_num(x[:, 1]) ** 2 + rng.normal(size=n) * 0.5 > 0.7).astype(float)
    w = rng.integers(1, 4, n).astype(float) if weighted else np.ones(n)
    cuts = [np.array([-1.05, -0.55, 0.05, 0.45, 0.95, 1.45])] * 3
    df = spark.createDataFrame([(*(None if v != v else float(v) for v in x[i]), int(y[i]), float(w[i])) for i in range(n)], "a double, b double, c double, y int, w double").repartition(3)
    model = fit_newton(df, ["a", "b", "c"], "y", trees=3, depth=2, rate=0.4, gamma=0.05, cuts=cuts, weight="w" if weighted else None)
    margin, nodes = plain_boost(x, y, w, cuts, 3, 2, 0.4, 1.0, 0.05)
    assert np.allclose(np.log(model.probability(x) / (1 - model.probability(x))), margin, atol=1e-9)
    for tree, want in zip(model.trees, nodes):
        assert set(tree) == set(want) and all(np.isclose(tree[k].weight, want[k]) for k in want)
    got = model.transform(df.select("a", "b", "c")).toPandas()
    assert got["p1"].between(0, 1).all() and len(got) == n


def test_margins_kept_between_trees_change_nothing(spark, monkeypatch):
    from cohort_engine.plans import newton_boost as N
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(a), float(b), int(a + b > 0)) for a, b in rng.normal(size=(80, 2))], "a double, b double, y int")
    want = fit_newton(df, ["a", "b"], "y", trees=4, depth=1).table()
    monkeypatch.setattr(N, "REFRESH", 1)
    got = fit_newton(df, ["a", "b"], "y", trees=4, depth=1).table()
    assert [(r[:4]) for r in got] == [(r[:4]) for r in want] and np.allclose([r[4:] for r in got], [r[4:] for r in want])


def test_lasso_paths(spark):
    rng = np.random.default_rng(2)
    n, p = 300, 6
    x = rng.normal(size=(n, p)) * [1, 2, 0.5, 1, 1, 3] + 40
    y = (x[:, 0] - x[:, 1] + rng.normal(size=n) > 0).astype(float)
    cols = [f"m{j}" for j in range(p)]
    df = spark.createDataFrame([(*map(float, x[i]), int(y[i]), i % 3) for i in range(n)], ", ".join(f"{c} double" for c in cols) + ", y int, fold int").repartition(3).persist()
    alphas = [0.001, 0.05, 0.1, 1.0]
    path = lasso_path(df, cols, "y", alphas, "fold", folds=range(3))
    rows = optimality(df, cols, "y", path, "fold").collect()
    assert len(rows) == 16 and all(r.worst < 1e-9 for r in rows) and {r.n_rows for r in rows} == {300, 200}
    assert all(r.n_selected == 0 for r in rows if r.alpha == 1.0) and all(r.n_selected == p for r in rows if r.alpha == 0.001 and r.fold == ALL)
    # a fold's weights are those of its rows alone
    alone = {(r.alpha, r.feature): r.coef for r in lasso_path(df.where("fold <> 1"), cols, "y", alphas).collect()}
    assert all(abs(alone[r.alpha, r.feature] - r.coef) < 1e-8 for r in path.where("fold = 1").collect())
    # weights count as copies
    twice = {(r.alpha, r.feature): r.coef for r in lasso_path(df.unionByName(df.where("fold = 0")), cols, "y", alphas).collect()}
    from pyspark.sql import functions as F
    heavy = lasso_path(df.withColumn("w", F.when(F.col("fold") == 0, 2).otherwise(1)), cols, "y", alphas, weight="w")
    assert all(abs(twice[r.alpha, r.feature] - r.coef) < 1e-8 for r in heavy.collect())
    none = lasso_path(df.limit(0), cols, "y", [0.1]).collect()
    assert [r.coef for r in none] == [0.0] * p
    with pytest.raises(ValueError):
        lasso_paths(df, 2_001, [0.1])
    df.unpersist()
