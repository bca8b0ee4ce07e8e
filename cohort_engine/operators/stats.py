"""Column statistics.

All statistics come back as small DataFrames keyed by feature (``len(cols)`` rows),
computed with partial (map-side) aggregation.  Wide tables are unpivoted into
``(feature, value)`` inside the same stage, so the number of aggregate expressions
does not grow with the column count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.functions.expressions import unfold
from cohort_engine.functions.quantiles import approx_quantiles, exact_quantiles


def to_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), drop_nulls: bool = True) -> DataFrame:
    """Unpivot ``cols`` into ``(*keys, feature, value double)``."""
    if not cols:
        return df.selectExpr(*keys, "'' AS feature", "CAST(NULL AS DOUBLE) AS value").limit(0)
    out = unfold(df, cols, keys)
    return out.where(F.col("value").isNotNull()) if drop_nulls else out


def class_balance(df: DataFrame, label: str = "response") -> DataFrame:
    """A1: one row ``(n_min, n_max, n_classes, ratio, strategy)``.

    strategy mirrors the reference's rule: ratio < 0.5 and 2*min < max gives
    'oversampling'; ratio < 0.5 otherwise 'undersampling'; else 'none'.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    agg = counts.agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"),
                     F.count(F.lit(1)).alias("n_classes"))
    ratio = F.col("n_min").cast("double") / F.col("n_max").cast("double")
    return agg.select(
        "n_min", "n_max", "n_classes", ratio.alias("ratio"),
        F.when((ratio < 0.5) & (F.col("n_min") * 2 < F.col("n_max")), "oversampling")
        .when(ratio < 0.5, "undersampling").otherwise("none").alias("strategy"),
    )


def feature_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A2: ``(feature, min_value, max_value)``."""
    return to_long(df, cols).groupBy("feature").agg(F.min("value").alias("min_value"),
                                                    F.max("value").alias("max_value"))


def any_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A3: one row, one boolean: is any cell of ``cols`` below zero."""
    if not cols:
        return df.sparkSession.createDataFrame([(False,)], "any_negative boolean")
    return to_long(df, cols).agg(F.coalesce(F.min("value") < 0, F.lit(False)).alias("any_negative"))


def has_negative(df: DataFrame, cols: Sequence[str]) -> bool:
    return bool(any_negative(df, cols).first()[0])


def moments(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """A4: ``(*group_cols, feature, n, mean, std_pop)`` over non-NULL cells."""
    return to_long(df, cols, keys=group_cols).groupBy(*group_cols, "feature").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std_pop"),
    )


def medians(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """A5: ``(feature, median)``; exact unless ``accuracy`` asks for a sketch."""
    q = quantiles(df, cols, [0.5], accuracy)
    return q.select("feature", F.col("value").alias("median"))


def quartiles(df: DataFrame, cols: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """``(feature, q1, q3)`` with linear interpolation."""
    q = quantiles(df, cols, [0.25, 0.75], accuracy)
    return q.groupBy("feature").agg(
        F.max(F.when(F.col("q") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q") == 0.75, F.col("value"))).alias("q3"),
    )


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int | None = None) -> DataFrame:
    if accuracy is None:
        return exact_quantiles(df, cols, probs)
    return approx_quantiles(df, cols, probs, rel_err=1.0 / accuracy)


def mean_std(df: DataFrame, value_cols: Sequence[str], group_cols: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of per-fold scores, per group."""
    aggs = []
    for v in value_cols:
        aggs += [F.avg(v).alias(f"{v}_mean"), F.stddev_pop(v).alias(f"{v}_std")]
    return df.groupBy(*group_cols).agg(*aggs)
