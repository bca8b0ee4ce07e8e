"""Recursive feature elimination on rows packed once."""

import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cohort_engine.operators import select as S
from cohort_engine.sources import fixtures as FX

COLS = ["a", "b", "c", "d", "e"]


def table(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 3, 0.5, 1] + [0, 40, 0, -2]
    y = (x @ [1.0, -0.2, 1.5, 0.1] + 8 + rng.normal(size=n) > 0).astype(float)
    w = rng.integers(0, 4, n).astype(float)
    rows = [(float(y[i]), *map(float, x[i]), 7.0, float(w[i])) for i in range(n)]
    return spark.createDataFrame(rows, "response double, a double, b double, c double, d double, e double, weight double").repartition(3)


@pytest.mark.parametrize("weight", [None, "weight"])
@pytest.mark.parametrize("step", [1, 2])
def test_the_ranking_is_that_of_a_fit_a_round(spark, weight, step):
    df = table(spark)
    found = S.rfe_path(df, COLS, "response", step=step, weight=weight)
    assert found == S._rfe_by_fits(df, COLS, "response", 1, step, 1.0, weight)
    assert sorted(found) == COLS and found[-1] == "e"          # the constant goes first


def test_a_round_is_at_its_minimum(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    from cohort_engine.plans import elimination as EL
    df = table(spark)
    rows = EL.pack(df, ["a", "b", "c"], "response", "weight")
    n = df.agg(F.sum("weight")).first()[0]
    beta, _ = EL.minimum(rows, 3, np.array([0, 2]), np.array([0.0, 40.0, 0.1]), n, 2.0, np.zeros(3))
    vec = VectorAssembler(inputCols=["a", "c"], outputCol="v").transform(df)
    m = LogisticRegression(featuresCol="v", labelCol="response", weightCol="weight", regParam=1 / (2.0 * n), elasticNetParam=0.0,
                           standardization=False, maxIter=1000, tol=1e-12).fit(vec)
    assert np.allclose(beta[:-1], m.coefficients.toArray(), rtol=1e-5)


def test_equal_columns_one_class_and_wrong_rows(spark):
    df = table(spark).withColumn("z", F.col("a"))
    path = S.rfe_path(df, ["z", "a", "c"], "response")
    assert path.index("z") < path.index("a")                    # equal weights: the first name goes first
    assert S.rfe_path(df.where("response = 1"), ["c", "a", "b"], "response") == ["c", "b", "a"]
    for bad in (df.withColumn("a", F.when(F.col("a") > 1, F.col("a"))), df.withColumn("response", F.lit(2.0)), df.where("false"),
                df.withColumn("weight", -F.col("weight"))):
        with pytest.raises(Exception):
            S.rfe_path(bad, ["a", "b"], "response", weight="weight")


def test_rounds_take_few_jobs(spark):
    """A fit a round from nothing took a job for every evaluation of every fit."""
    df, sc, group = table(spark).persist(), spark.sparkContext, uuid.uuid4().hex
    df.count()
    sc.setJobGroup(group, "rfe")
    try:
        S.rfe_path(df, COLS, "response")
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
    assert len(sc.statusTracker().getJobIdsForGroup(group)) <= 40
    df.unpersist()


def test_the_cohort_is_made_once_and_released(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    def cohort(s, d):
        rows = [(i, int(i % 7 < 3 or i % 5 == 0), float(i % 121), "M" if i % 2 else "F", float(i % 4), float(i % 97), float(i % 7), 7.0) for i in range(600)]
        df = s.createDataFrame(rows, "patient_id long, response int, age double, sex string, batch double, price double, qty double, constant_col double")

        def count(batches):
            for b in batches:
                seen.add(b.num_rows)
                yield b
        return df.repartition(2).mapInArrow(count, df.schema)

    monkeypatch.setattr(FX, "c5_signal", cohort)
    held = set(spark.sparkContext._jsc.getPersistentRDDs())
    ranked = [r.feature for r in E.queries()["rfe_ranking"](spark, "").orderBy("position").collect()]
    assert sorted(ranked) == ["age", "price", "qty", "sex"]
    assert seen.value == 600
    assert not set(spark.sparkContext._jsc.getPersistentRDDs()) - held
