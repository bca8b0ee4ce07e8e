"""Table readers (S1) and cohort union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.functions.expressions import name, replace_columns, text


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Texts a CSV reader takes for a missing cell (fixed values: the defaults of the reference's reader).
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
           "None", "n/a", "nan", "null")


def missing_to_null(df: DataFrame) -> DataFrame:
    """Missing markers in text columns, and NaN or infinity in floating ones, become NULL."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    markers = ", ".join(map(text, MISSING))
    marked = replace_columns(df, {c: f"CASE WHEN {name(c)} NOT IN ({markers}) THEN {name(c)} END" for c in texts}) if texts else df
    return nan_to_null(marked)


def read_csvs(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One or more header CSVs, every column read as a string.

    Types are decided by :func:`cohort_engine.sources.validate.coerce` (S2), never by
    inference: ``inferSchema`` turns a numeric column holding ``nan`` into a string
    column and costs an extra pass.  Several paths are combined by column name,
    missing columns become NULL (S4).
    """
    if isinstance(paths, str):
        paths = [paths]
    frames = [missing_to_null(spark.read.option("header", True).option("inferSchema", False).csv(p)) for p in paths]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def union_cohorts(frames: Sequence[DataFrame], source_col: str | None = "source") -> DataFrame:
    """Row-concatenate cohorts by column name; absent columns become NULL.

    When ``source_col`` is set, each row records the position of the frame it came
    from, so the concatenation stays traceable (the reference resets the index).
    """
    out = None
    for i, f in enumerate(frames):
        g = f.withColumn(source_col, F.lit(i)) if source_col else f
        out = g if out is None else out.unionByName(g, allowMissingColumns=True)
    return out


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NaN and +/-inf become NULL in floating columns.

    Spark aggregates treat NaN as a value (the largest one); the reference treats
    NaN and infinities as missing.  Normalising once at ingest keeps every later
    statistic NULL-skipping.
    """
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in floating]
    if not targets:
        return df
    return replace_columns(df, {c: f"CASE WHEN NOT isnan({name(c)}) AND abs({name(c)}) < double('infinity') THEN {name(c)} END" for c in targets})
