"""Entry points not covered by the registered queries: CSV ingest, error paths,
the two ANOVA layouts, k-range rule, grids."""

import pytest
from pyspark.sql import functions as F

from cohort_engine.operators import outliers as O
from cohort_engine.operators import select as S
from cohort_engine.plans import models as MD
from cohort_engine.sources import fixtures as FX
from cohort_engine.sources.tables import read_csvs, union_cohorts
from cohort_engine.sources.validate import validate

from conftest import SF_SMALL


def test_csv_ingest_validates_and_unions(spark, tmp_path):
    c1 = FX.c1_orders(spark, SF_SMALL).drop("lines")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    c1.where("batch < 2").write.option("header", True).csv(a)
    c1.where("batch >= 2").drop("tax").write.option("header", True).csv(b)
    raw = read_csvs(spark, [a, b])
    assert all(t == "string" for _, t in raw.dtypes)
    ok = validate(raw)
    assert ok.count() == c1.count()
    assert dict(ok.dtypes)["qty"] == "double" and dict(ok.dtypes)["response"] == "int"
    assert ok.where("tax IS NULL AND CAST(batch AS DOUBLE) >= 2").count() == c1.where("batch >= 2").count()
    u = union_cohorts([c1.limit(5), c1.limit(3).drop("tax")])
    assert u.groupBy("source").count().orderBy("source").collect()[1]["count"] == 3


def test_error_paths(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    with pytest.raises(ValueError):
        O.report(df, ["a"], method="nope")                  # O5
    with pytest.raises(ValueError):
        MD.canonical("boosted_magic")                        # E7
    with pytest.raises(ValueError):
        S.select_method("chi2")                              # F6
    assert MD.canonical("rf") == "random_forest" and MD.canonical("xgb") == "xgboost"


def test_anova_odd_columns(spark):
    rows = [(0, 1.0, None, 5.0), (1, 2.0, None, 5.0)]
    got = {r.feature: r.f_score for r in S.anova_f(spark.createDataFrame(rows, "response int, a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert got == {"a": None, "b": None, "c": None}        # one row a class, all NULL, constant


def test_k_range_and_grid_sizes():
    assert S.k_range(64) == list(range(10, 65, 5))[:11]
    assert S.k_range(23) == [10, 15, 20] and S.k_range(7) == [7]
    ks = S.k_range(64)
    sizes = {a: len(MD.param_grid("anova", a, ks)) for a in MD.MODEL_GRIDS}
    assert sizes == {"logistic_regression": 44, "svm": 66, "xgboost": 88, "random_forest": 66, "cart": 66}
    assert len(MD.param_grid("lasso", "svm", ks)) == 24
