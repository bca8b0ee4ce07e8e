"""Feature ranking and selection (F1, F3-F6; mutual information in ``mutual_info``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.operators.stats import to_long


def k_range(n_features: int) -> list[int]:
    """F5 (a fixed rule of the reference): {10, 15, ..., 60} up to the feature count, else [min(10, n)]."""
    ks = [k for k in range(10, 65, 5) if k <= n_features]
    return ks or [min(10, n_features)]


def anova_f(df: DataFrame, cols: Sequence[str], label: str = "response", weight: str | None = None) -> DataFrame:
    """F1 scores: one-way ANOVA F of each feature against the class.

    From per-(feature, class) count, mean and population variance (a partial
    aggregate over unpivoted cells, NULL cells skipped):
    ``F = [sum_c n_c (mean_c - mean)^2 / (k - 1)] / [sum_c n_c var_c / (N - k)]``.
    Variances come from Spark's stable merge, so large means do not cancel.
    Undefined F (no within-class spread, one class) is NULL and ranks last.  With
    ``weight``, a row stands for that many equal rows: moments are taken per weight,
    of which there are few, and merged.
    """
    per = to_long(df, cols, keys=[label, *([weight] if weight else [])]).groupBy("feature", label, *([weight] if weight else [])).agg(
        F.count("value").alias("n_c"), F.avg("value").alias("mean_c"), F.var_pop("value").alias("var_c"))
    if weight:
        per = per.checkpoint()               # features x classes x weights rows, read four times
        n = F.col("n_c") * F.col(weight)
        means = per.groupBy("feature", label).agg(F.sum(n).alias("total"), (F.sum(n * F.col("mean_c")) / F.sum(n)).alias("mean"))
        per = (per.join(means, ["feature", label])
               .groupBy("feature", label, F.col("total").alias("n_c"), F.col("mean").alias("m"))
               .agg((F.sum(n * (F.col("var_c") + (F.col("mean_c") - F.col("mean")) ** 2)) / F.first("total")).alias("var_c"))
               .withColumnRenamed("m", "mean_c"))
    scored = f_from_moments(per)
    # a column of NULLs alone has no row in the long form
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(scored, "feature", "left")


def f_from_moments(per: DataFrame) -> DataFrame:
    """``(feature, f_score)`` from one row ``(feature, n_c, mean_c, var_c)`` per feature and class."""
    tot = per.groupBy("feature").agg(
        F.sum("n_c").alias("n"), (F.sum(F.col("n_c") * F.col("mean_c")) / F.sum("n_c")).alias("grand"),
        F.count(F.lit(1)).alias("k"))
    j = per.join(tot, "feature")
    parts = j.groupBy("feature", "n", "k").agg(
        F.sum(F.col("n_c") * (F.col("mean_c") - F.col("grand")) ** 2).alias("ssb"),
        F.sum(F.col("n_c") * F.col("var_c")).alias("ssw"))
    between = F.try_divide(F.col("ssb"), F.col("k") - 1)
    within = F.try_divide(F.col("ssw"), F.col("n") - F.col("k"))
    return parts.select("feature", F.try_divide(between, within).alias("f_score"))


def anova_ranking(df: DataFrame, cols: Sequence[str], label: str = "response", weight: str | None = None) -> list[str]:
    """Features in ANOVA-F order (best first, NULL last, ties by name)."""
    return ranked(anova_f(df, cols, label, weight))


def top_k(scores: DataFrame, k: int, score_col: str = "f_score") -> DataFrame:
    """Best ``k`` features: score descending, NULL last, ties by name."""
    return scores.orderBy(F.col(score_col).desc_nulls_last(), F.col("feature")).limit(k)


def ranked(scores: DataFrame, score_col: str = "f_score") -> list[str]:
    """Every feature in selection order (``len(cols)`` rows collected)."""
    rows = scores.orderBy(F.col(score_col).desc_nulls_last(), F.col("feature")).select("feature").collect()
    return [r.feature for r in rows]


def lasso_select(df: DataFrame, cols: Sequence[str], label: str = "response", alpha: float = 0.01,
                 threshold: float = 1e-5, max_iter: int = 10_000) -> list[str]:
    """features with ``|coef| > threshold`` in an L1 linear regression of the
    0/1 label (objective ``1/(2n)||y - Xw||^2 + alpha ||w||_1``)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    vec = VectorAssembler(inputCols=list(cols), outputCol="__v", handleInvalid="keep").transform(
        df.select(*cols, F.col(label).cast("double").alias("__y")))
    lr = LinearRegression(featuresCol="__v", labelCol="__y", regParam=alpha, elasticNetParam=1.0,
                          standardization=False, maxIter=max_iter, tol=1e-6)
    coef = lr.fit(vec).coefficients.toArray()
    return [c for c, w in zip(cols, coef) if abs(w) > threshold]


def rfe_path(df: DataFrame, cols: Sequence[str], label: str = "response", min_k: int = 1,
             step: int = 1, reg_c: float = 1.0, weight: str | None = None) -> list[str]:
    """recursive feature elimination with logistic regression.

    Returns all features in elimination order reversed (the last survivor first),
    so the first ``k`` entries are RFE's choice for every ``k >= min_k`` -- one run
    serves the whole k grid.  The rounds share rows packed once
    (``plans/elimination``); beyond the features whose curvature fits, each round is
    one distributed fit over cached vectors.  Only numbers by feature come back.
    """
    from cohort_engine.plans.elimination import MAX_FEATURES, eliminate

    if min_k < len(cols) <= MAX_FEATURES:
        return eliminate(df, cols, label, min_k, step, reg_c, weight)
    return _rfe_by_fits(df, cols, label, min_k, step, reg_c, weight)


def _rfe_by_fits(df: DataFrame, cols: Sequence[str], label: str, min_k: int, step: int, reg_c: float,
                 weight: str | None) -> list[str]:
    """The same by one fit of Spark's own solver a round."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    remaining = list(cols)
    eliminated: list[str] = []
    base = df.select(*cols, F.col(label).cast("double").alias("__y"), (F.col(weight) if weight else F.lit(1)).cast("double").alias("__w")).persist()
    n = base.agg(F.sum("__w")).first()[0] or 1
    try:
        while len(remaining) > min_k:
            vec = VectorAssembler(inputCols=remaining, outputCol="__v").transform(base)
            lr = LogisticRegression(featuresCol="__v", labelCol="__y", weightCol="__w", regParam=1.0 / (reg_c * n),
                                    elasticNetParam=0.0, standardization=False, maxIter=1000)
            w = abs(lr.fit(vec).coefficients.toArray())
            drop_n = min(step, len(remaining) - min_k)
            order = sorted(range(len(remaining)), key=lambda i: (w[i], remaining[i]))[:drop_n]
            gone = [remaining[i] for i in order]
            eliminated.extend(gone)
            remaining = [c for c in remaining if c not in gone]
    finally:
        base.unpersist()
    return remaining + list(reversed(eliminated))


def select_method(method: str):
    if method in ("anova", "mutual_info", "lasso", "rfe"):
        return method
    raise ValueError(f"no such way of selecting features: {method!r}")      # F6
