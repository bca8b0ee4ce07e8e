"""Outlier-prone feature screening.

Each method returns a report DataFrame with one row per feature and a ``flagged``
flag; :func:`flagged` collects the flagged names (bounded by the column count) and
:func:`cohort_engine.operators.columns.drop_features` removes them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.operators.stats import quartiles, to_long

# fixed defaults of the reference's outlier remover
IQR_THRESHOLD = 0.05
ZSCORE_THRESHOLD = 0.05
ZSCORE_LIMIT = 3.0
ISO_FOREST_THRESHOLD = 0.05
PCA_ERROR_THRESHOLD = 0.1


def iqr_report(df: DataFrame, cols: Sequence[str], threshold: float = IQR_THRESHOLD,
               accuracy: int | None = None) -> DataFrame:
    """O1: share of rows outside ``[Q1 - 1.5 IQR, Q3 + 1.5 IQR]`` (NULL counts as inside;
    the denominator is every row).  Bounds are ``len(cols)`` rows -> broadcast."""
    q = quartiles(df, cols, accuracy).select(
        "feature", "q1", "q3",
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("upper"))
    long = to_long(df, cols, drop_nulls=False)
    j = long.join(F.broadcast(q), "feature")
    out = F.when((F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper")), 1.0).otherwise(0.0)
    share = j.groupBy("feature").agg(F.avg(out).alias("outlier_share"))
    return (q.join(share, "feature", "left")
            .withColumn("flagged", F.col("outlier_share") > F.lit(threshold)))


def zscore_report(df: DataFrame, cols: Sequence[str], threshold: float = ZSCORE_THRESHOLD,
                  limit: float = ZSCORE_LIMIT) -> DataFrame:
    """O2: share of rows with ``|x| > limit``.  No z-score is computed: the input is
    expected to be standardised already (as in the reference's pipeline)."""
    long = to_long(df, cols, drop_nulls=False)
    share = long.groupBy("feature").agg(
        F.avg(F.when(F.abs(F.col("value")) > F.lit(limit), 1.0).otherwise(0.0)).alias("outlier_share"))
    return share.withColumn("flagged", F.col("outlier_share") > F.lit(threshold))


def pca_report(df: DataFrame, cols: Sequence[str], threshold: float = PCA_ERROR_THRESHOLD,
               n_components: int | None = None) -> DataFrame:
    """Mean absolute reconstruction error per feature from the top-k principal
    components (k = ``n_components`` or min(10, p)), data centred as PCA requires.

    Components come from ``pyspark.ml.feature.PCA`` (distributed covariance).  The
    error is summed per partition with numpy in ``mapInPandas`` (one ``p``-vector
    per Arrow batch) and reduced by a plain aggregate.
    """
    from pyspark.ml.feature import PCA, VectorAssembler

    cols = list(cols)
    p = len(cols)
    k = min(n_components or min(10, p), p)
    means_row = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    means = np.array([means_row[c] or 0.0 for c in cols], dtype=float)
    centred = df.select(*[(F.coalesce(F.col(c), F.lit(float(m))) - F.lit(float(m))).alias(c)
                          for c, m in zip(cols, means)])
    vec = VectorAssembler(inputCols=cols, outputCol="__v").transform(centred).select("__v")
    model = PCA(k=k, inputCol="__v", outputCol="__pc").fit(vec)
    V = model.pc.toArray()                      # p x k, bounded by the column count
    proj = V @ V.T

    def partial(batches):
        import pandas as pd
        for b in batches:
            x = b[cols].to_numpy(dtype=float)
            err = np.abs(x - x @ proj).sum(axis=0)
            yield pd.DataFrame({"feature": cols, "abs_err": err, "n": np.full(p, len(x), dtype=np.int64)})

    parts = centred.mapInPandas(partial, "feature string, abs_err double, n long")
    rep = parts.groupBy("feature").agg((F.sum("abs_err") / F.sum("n")).alias("reconstruction_error"))
    return rep.withColumn("flagged", F.col("reconstruction_error") > F.lit(threshold))


def report(df: DataFrame, cols: Sequence[str], method: str = "iqr", **kw) -> DataFrame:
    if method == "iqr":
        return iqr_report(df, cols, kw.get("iqr_threshold", IQR_THRESHOLD))
    if method == "zscore":
        return zscore_report(df, cols, kw.get("zscore_threshold", ZSCORE_THRESHOLD),
                             kw.get("zscore_limit", ZSCORE_LIMIT))
    if method == "isolation_forest":
        from cohort_engine.operators.isoforest import isolation_report
        return isolation_report(df, cols, kw.get("iso_forest_threshold", ISO_FOREST_THRESHOLD))
    if method == "pca":
        return pca_report(df, cols, kw.get("pca_reconstruction_error_threshold", PCA_ERROR_THRESHOLD),
                          kw.get("n_components_pca"))
    raise ValueError(f"no such outlier screen: {method!r}")          # O5


def flagged(report_df: DataFrame) -> list[str]:
    return sorted(r.feature for r in report_df.where("flagged").select("feature").collect())
