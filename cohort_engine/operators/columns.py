"""Projections and column bookkeeping.

These only rearrange the plan: every one is a ``select``/``drop`` (no job) except
:func:`constant_columns`, which is a single aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.functions.expressions import unfold

ID_COLUMNS = ("patient_id", "patient")


def lower_names(df: DataFrame) -> DataFrame:
    """Lower-case every column name; two names that collide are an error."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) != len(lowered):
        dup = sorted({c for c in lowered if lowered.count(c) > 1})
        raise ValueError(f"column names collide after lower-casing: {dup}")
    return df.toDF(*lowered)


def feature_columns(df: DataFrame, response: str = "response", batch: str | None = "batch",
                    id_cols: Sequence[str] = ID_COLUMNS, extra_keys: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are features -- not ids, response, batch or keys."""
    skip = {response, *id_cols, *extra_keys}
    if batch:
        skip.add(batch)
    return [f.name for f in df.schema.fields
            if f.name not in skip and isinstance(f.dataType, T.NumericType)]


def encode_sex(df: DataFrame, col: str = "sex") -> DataFrame:
    """M -> 0.0, F -> 1.0, anything else NULL (so the scaler can take it)."""
    if col not in df.columns or isinstance(df.schema[col].dataType, T.NumericType):
        return df
    c = F.col(col)
    return df.withColumn(col, F.when(c == "M", 0.0).when(c == "F", 1.0).otherwise(F.lit(None).cast("double")))


def split_xy(df: DataFrame, response: str = "response", **kw) -> tuple[list[str], str]:
    """Feature names and the response name; missing response is an error."""
    response = response.lower()
    if response not in df.columns:
        raise ValueError(f"response column '{response}' not found")
    return feature_columns(df, response=response, **kw), response


def constant_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P4 report ``(feature, n_non_null, min_value, max_value, is_constant)``.

    A column is constant when it has at most one distinct non-NULL value, i.e. it is
    all NULL (NaN counts as NULL) or its min equals its max -- decided by one partial aggregate, no
    distinct shuffle.
    """
    long = unfold(df, cols).withColumn("value", F.nanvl("value", F.lit(None).cast("double")))
    agg = long.groupBy("feature").agg(
        F.count("value").alias("n_non_null"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
    )
    return agg.withColumn("is_constant",
                          (F.col("n_non_null") == 0) | (F.col("min_value") == F.col("max_value")))


def drop_constant(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str], list[str]]:
    """Returns ``(df without constant columns, kept features, dropped features)``."""
    rep = constant_columns(df, cols).where("is_constant").select("feature").collect()
    dropped = sorted(r.feature for r in rep)
    kept = [c for c in cols if c not in dropped]
    return df.drop(*dropped), kept, dropped


def _number(df: DataFrame, c: str):
    """The column as double; text that is no number becomes NULL."""
    return F.col(c).cast("double") if isinstance(df.schema[c].dataType, T.NumericType) else F.col(c).cast("string").try_cast("double")


def align_columns(df: DataFrame, train_cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """P5: reorder to the training columns, drop extras, absent columns become 0.0."""
    present = set(df.columns)
    sel = [F.col(k) for k in keep if k in present]
    sel += [_number(df, c).alias(c) if c in present else F.lit(0.0).alias(c) for c in train_cols]
    return df.select(*sel)


def select_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project the selected features (plus key columns)."""
    return df.select(*[c for c in keep if c in df.columns], *names)


def drop_features(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop flagged features; names that are absent are ignored."""
    return df.drop(*[n for n in names if n in df.columns])
