"""Shared primitives against pandas / numpy."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohort_engine.functions.cumulative import running_sum
from cohort_engine.functions.digamma import digamma_exact, digamma_py
from cohort_engine.functions.quantiles import exact_quantiles, quantile_dict


def test_running_sum_matches_cumsum(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 3).alias("g"),
                                     ((F.col("id") * 7919) % 1000).cast("double").alias("x"))
    out = running_sum(df, ["x", "id"], ["id"], partition_cols=["g"], n_buckets=7).toPandas()
    pdf = df.toPandas().sort_values(["g", "x", "id"])
    pdf["want"] = pdf.groupby("g")["id"].cumsum()
    m = out.merge(pdf, on=["id", "g", "x"])
    assert len(m) == 5000 and (m["cum_id"] == m["want"]).all()


import pytest


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 1999, 2001, 9000])
def test_exact_quantiles_with_hot_value_and_nulls(spark, n):
    rows = [(float((i * 37) % 50) if i % 3 else 0.0, None if i % 7 == 0 else float((i * 7919) % n), None, float((i * 31) % n) ** 2) for i in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = quantile_dict(exact_quantiles(df, ["a", "b", "c", "d"], probs))
    pdf = pd.DataFrame(rows, columns=["a", "b", "c", "d"]).astype(float)
    for c in ["a", "b", "c", "d"]:
        for p in probs:
            want = pdf[c].quantile(p)
            assert (q[(c, p)] is None and want != want) or abs(q[(c, p)] - want) <= 1e-9 * max(1.0, abs(want)), (c, p)


def test_digamma():
    from math import log
    assert abs(digamma_exact(1) + 0.5772156649015329) < 1e-15
    for n in [10, 11, 50, 1000]:
        assert abs(digamma_py(n) - digamma_exact(n)) < 1e-11
    assert abs(digamma_py(10 ** 6) - log(10 ** 6)) < 1e-6


def test_rows_of_a_partition_are_bounded(spark):
    """a tree fit keeps about 500 bytes a row, and a task reads its partition in every round."""
    from cohort_engine.functions.partitions import target_partitions
    assert 54_000_000 / target_partitions(spark.range(1), 54_000_000) * 500 < 150e6
