"""Schema coercion and lazy validation of sample tables (S2, S2a-e, S3).

Rules (fixed values of the sample-table contract):

    response   required, not NULL, whole number in {0, 1}
    age        optional, NULL allowed, 0 <= age <= 120 (inclusive)
    sex        optional, NULL allowed, one of 'M', 'F'
    patient_id, patient   optional row keys, any type, never coerced
    batch      optional group key, kept as it is (never a feature)
    any other column      optional, NULL allowed, coerced to double

Validation is lazy: one pass gathers every failing cell into a violations
DataFrame ``(row_id, column_name, check_name, failure_case)`` instead of stopping at
the first one.  :func:`validate` raises with the first 20 failures, like the
reference; the full table stays available from :func:`violations`.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.functions.expressions import name, replace_columns
from cohort_engine.operators.columns import lower_names
from cohort_engine.sources.tables import missing_to_null


@dataclass(frozen=True)
class SampleSchema:
    response: str = "response"
    id_cols: tuple[str, ...] = ("patient_id", "patient")
    batch_col: str = "batch"
    # fixed values of the contract
    age_range: tuple[float, float] = (0.0, 120.0)
    sex_values: tuple[str, ...] = ("M", "F")
    response_values: tuple[int, ...] = (0, 1)
    # columns the wildcard rule applies to: everything except response, age, sex
    wildcard: str = field(default=r"^(?!response$|age$|sex$).*")

    def numeric_columns(self, columns: list[str]) -> list[str]:
        skip = {self.response, "age", "sex", self.batch_col, *self.id_cols}
        pat = re.compile(self.wildcard)
        return [c for c in columns if c not in skip and pat.match(c)]


class SchemaViolation(ValueError):
    def __init__(self, message: str, report: DataFrame):
        super().__init__(message)
        self.report = report


VIOLATION_SCHEMA = T.StructType([
    T.StructField("row_id", T.StringType(), True),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("check_name", T.StringType(), False),
    T.StructField("failure_case", T.StringType(), True),
])


def _fail(column: str, check: str, value: Column | None) -> Column:
    return F.struct(F.lit(column).alias("column_name"), F.lit(check).alias("check_name"),
                    (value.cast("string") if value is not None else F.lit(None).cast("string"))
                    .alias("failure_case"))


def _as_double(df: DataFrame, c: str) -> Column:
    """The number a cell holds: its cast, which ``_with_numbers`` has put beside it once."""
    return F.col(f"__as_double_{c}") if f"__as_double_{c}" in df.columns else F.col(c).cast("double")


def _with_numbers(df: DataFrame) -> DataFrame:
    """Every text column's cast to double beside it, so that checks do not cast again."""
    texts = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    return df.selectExpr("*", *(f"TRY_CAST(CAST({name(c)} AS STRING) AS DOUBLE) AS {name('__as_double_' + c)}" for c in texts)) if texts else df


def _checks(df: DataFrame, schema: SampleSchema) -> list[Column]:
    """One nullable struct per (column, check); non-NULL means the cell fails."""
    cols = set(df.columns)
    out: list[Column] = []
    r = schema.response
    if r in cols:
        raw = F.col(r)
        as_d = _as_double(df, r)
        allowed = F.lit(False)
        for v in schema.response_values:
            allowed = allowed | (as_d == F.lit(float(v)))
        out.append(F.when(raw.isNull(), _fail(r, "not_nullable", None)))
        out.append(F.when(raw.isNotNull() & as_d.isNull(), _fail(r, "coerce_dtype('int')", raw)))
        out.append(F.when(as_d.isNotNull() & ~allowed,
                          _fail(r, f"isin({list(schema.response_values)})", raw)))
    if "age" in cols:
        raw = F.col("age")
        as_d = _as_double(df, "age")
        lo, hi = schema.age_range
        out.append(F.when(raw.isNotNull() & as_d.isNull(), _fail("age", "coerce_dtype('float')", raw)))
        out.append(F.when(as_d.isNotNull() & ~as_d.between(lo, hi),
                          _fail("age", f"in_range({lo:g}, {hi:g})", raw)))
    if "sex" in cols:
        raw = F.col("sex").cast("string")
        out.append(F.when(raw.isNotNull() & ~raw.isin(*schema.sex_values),
                          _fail("sex", f"isin({list(schema.sex_values)})", raw)))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for c in schema.numeric_columns([c for c in df.columns if not c.startswith("__as_double_")]):
        if isinstance(kinds[c], T.NumericType):
            continue
        raw = F.col(c)
        as_d = _as_double(df, c)
        out.append(F.when(raw.isNotNull() & as_d.isNull(), _fail(c, "coerce_dtype('float')", raw)))
    return out


def row_key(df: DataFrame, schema: SampleSchema) -> Column:
    for c in schema.id_cols:
        if c in df.columns:
            return F.col(c).cast("string")
    # no id column: a row is known by its content (equal rows fail alike)
    return F.sha2(F.to_json(F.struct(*df.columns)), 256)


def violations(df: DataFrame, schema: SampleSchema = SampleSchema()) -> DataFrame:
    """S3: every failing cell, gathered in one pass over the rows.  Missing markers and
    NaN are missing cells, not failures."""
    df = missing_to_null(lower_names(df))
    spark = df.sparkSession
    missing = []
    if schema.response not in df.columns:                       # S2a, driver metadata only
        missing.append((None, schema.response, "column_in_dataframe", None))
    key = row_key(df, schema)
    df = _with_numbers(df)
    checks = _checks(df, schema)
    if checks:
        cells = df.select(key.alias("row_id"),
                          F.filter(F.array(*checks), lambda x: x.isNotNull()).alias("__f"))
        rep = cells.select("row_id", F.inline("__f"))
    else:
        rep = spark.createDataFrame([], VIOLATION_SCHEMA)
    if missing:
        rep = spark.createDataFrame(missing, VIOLATION_SCHEMA).unionByName(rep)
    return rep


def coerce(df: DataFrame, schema: SampleSchema = SampleSchema()) -> DataFrame:
    """Lower-case names, then cast to the declared types.

    ``response`` becomes int only when it is a whole number (a plain double->int
    cast would truncate 0.5 to 0); otherwise NULL, which :func:`violations` reports.
    Ids and batch are kept as they are; every other column is ``try_cast`` to double.
    Missing markers and NaN become NULL first.
    """
    df = missing_to_null(lower_names(df))
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def as_double(c: str) -> str:
        q = name(c)
        return f"CAST({q} AS DOUBLE)" if isinstance(kinds[c], T.NumericType) else f"TRY_CAST(CAST({q} AS STRING) AS DOUBLE)"

    repl = {c: as_double(c) for c in schema.numeric_columns(df.columns)}
    r = schema.response
    if r in kinds:
        d = as_double(r)
        repl[r] = f"CASE WHEN {d} = floor({d}) THEN TRY_CAST({d} AS INT) END"
    if "age" in kinds:
        repl["age"] = as_double("age")
    if "sex" in kinds:
        repl["sex"] = "CAST(sex AS STRING)"
    return replace_columns(df, repl)


def validate(df: DataFrame, schema: SampleSchema = SampleSchema(), show: int = 20) -> DataFrame:
    """Coerce and check; raise :class:`SchemaViolation` listing the first ``show`` failures."""
    rep = violations(df, schema)
    first = rep.orderBy("row_id", "column_name", "check_name").limit(show).collect()
    if first:
        lines = "\n".join(f"  row {r.row_id}: {r.column_name} {r.check_name} -> {r.failure_case}" for r in first)
        raise SchemaViolation(f"schema validation failed; first {len(first)} failures:\n{lines}", rep)
    return coerce(df, schema)
