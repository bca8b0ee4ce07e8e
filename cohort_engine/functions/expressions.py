"""SQL text for projections over many columns.

A table of thousands of columns is projected from one list of SQL texts, which the JVM
parses at once; building the same expressions call by call takes seconds per thousand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    return f"CAST({value!r} AS DOUBLE)" if value == value and abs(value) != float("inf") else f"double({text(str(value))})"


def replace_columns(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """``df`` with some columns replaced by SQL expressions, in place."""
    return df.selectExpr(*[f"{exprs[c]} AS {name(c)}" if c in exprs else name(c) for c in df.columns])


def unfold(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = (), index: bool = False) -> DataFrame:
    """``(*keys, feature | i, value double)``: a row for every cell of ``cols``."""
    label = (lambda i, c: f"'i', {i}") if index else (lambda i, c: f"'feature', {text(c)}")
    cells = ", ".join(f"named_struct({label(i, c)}, 'value', CAST({name(c)} AS DOUBLE))" for i, c in enumerate(cols))
    return df.selectExpr(*[name(k) for k in keys], f"inline(array({cells}))")


def round_column(df: DataFrame, col: str, digits: int) -> DataFrame:
    """``col`` as ``round(col, digits) + 0.0`` gives it, by arithmetic wherever the value is not so near a tie, or so large,
    that its decimal digits decide: Spark's ``round`` writes every double as text."""
    scale = 10.0 ** digits
    kept = [F.col(c) for c in df.columns]
    steps = df.select(*kept, (F.col(col) * scale).alias("__scaled"))
    steps = steps.select(*kept, "__scaled", F.floor(F.when(F.abs("__scaled") < 1e9, F.col("__scaled") + 0.5)).alias("__whole"))
    plain = F.abs(F.col("__scaled") - F.col("__whole")) < 0.5 - 1e-6                # off by 1e-7 at most below 1e9
    value = F.when(plain, F.col("__whole") / scale).otherwise(F.round(F.col(col), digits)) + 0.0
    return steps.select(*[value.alias(c) if c == col else F.col(c) for c in df.columns])
