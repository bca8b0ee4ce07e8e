"""Exact and approximate per-column quantiles without a single-task reducer.

``exact_quantiles`` finds order statistics by distributed selection, in long form,
whatever the number of rows and columns:

1. per column, a sketch gives two values that enclose each wanted order statistic
   (its rank error is known, so they surely do);
2. the cells between the two are counted by value, those below them as one number,
   both map-side, and the few values in between are ranked.

A window holds the distinct values of one bracket: ``4 * SKETCH_ERROR`` of a column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_QSCHEMA = T.StructType([
    T.StructField("feature", T.StringType(), False),
    T.StructField("q", T.DoubleType(), False),
])

SKETCH_ERROR = 0.001      # rank error of the bracketing sketch, as a share of a column


def cut_points(df: DataFrame, cols: Sequence[str], n_buckets: int, rel_err: float = 0.001,
               with_count: bool = False):
    """Strictly increasing inner cut points per column at the ``i / n_buckets``
    approximate quantiles (one aggregate pass; ``len(cols) x n_buckets`` numbers).
    With ``with_count`` the row count of the same pass is returned too."""
    probs = [i / n_buckets for i in range(1, n_buckets)]
    accuracy = max(100, int(round(1.0 / rel_err)))
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.percentile_approx(F.col(c).cast("double"), probs, accuracy).alias(f"c{i}")
                   for i, c in enumerate(cols)]).first()
    out = []
    for i in range(len(cols)):
        inner: list[float] = []
        for v in row[f"c{i}"] or []:
            if v is not None and (not inner or v > inner[-1]):
                inner.append(float(v))
        out.append(inner)
    return (out, row["__rows"]) if with_count else out


_WANTED = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("q", T.DoubleType()),
    T.StructField("low", T.DoubleType()), T.StructField("high", T.DoubleType()),
    T.StructField("first", T.LongType()), T.StructField("second", T.LongType()),
    T.StructField("frac", T.DoubleType()),
])


def _brackets(long: DataFrame, probs: Sequence[float]) -> list[tuple]:
    """One row per column and probability: the enclosing values and the wanted ranks."""
    reach = 2 * SKETCH_ERROR
    marks = [m for q in probs for m in (max(0.0, q - reach), min(1.0, q + reach))]
    sketched = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx("value", marks, int(1 / SKETCH_ERROR)).alias("marks")).collect()
    wanted = []
    for r in sketched:
        for i, q in enumerate(probs):
            pos = float(q) * (r["n"] - 1)
            low, high = r["marks"][2 * i], r["marks"][2 * i + 1]
            # the sketch is off by at most its error; a rank and its rounding by two cells
            if q <= reach or r["n"] * SKETCH_ERROR < 2:
                low = -math.inf
            if q >= 1 - reach or r["n"] * SKETCH_ERROR < 2:
                high = math.inf
            wanted.append((r["feature"], float(q), float(low), float(high), math.floor(pos), math.ceil(pos),
                           pos - math.floor(pos)))
    return wanted


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Long table ``(feature, q, value)``: exact quantiles of each column.

    Linear interpolation between the order statistics at ``floor`` and ``ceil`` of
    ``q * (n - 1)``; NULL cells are skipped; an all-NULL column gives NULL.
    """
    from cohort_engine.operators.stats import to_long

    spark = df.sparkSession
    cols = list(cols)
    grid = spark.createDataFrame([(c, float(q)) for c in cols for q in probs], _QSCHEMA)
    if not cols:
        return grid.withColumn("value", F.lit(None).cast("double"))
    long = to_long(df, cols)
    wanted = F.broadcast(spark.createDataFrame(_brackets(long, probs), _WANTED))      # columns x probabilities rows
    cells = (long.join(wanted, "feature").where(F.col("value") <= F.col("high"))
             .withColumn("inside", F.when(F.col("value") >= F.col("low"), F.col("value")))
             .groupBy("feature", "q", "first", "second", "frac", "inside").agg(F.count(F.lit(1)).alias("cnt")))
    upto = Window.partitionBy("feature", "q").orderBy(F.col("inside").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranked = cells.withColumn("cum", F.sum("cnt").over(upto))

    def at(rank: str):
        return F.max(F.when((F.col("cum") > F.col(rank)) & (F.col("cum") - F.col("cnt") <= F.col(rank)), F.col("inside")))

    picked = (ranked.groupBy("feature", "q").agg(at("first").alias("lo"), at("second").alias("hi"), F.max("frac").alias("frac"))
              .select("feature", "q", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias("value")))
    return grid.join(picked, ["feature", "q"], "left")


def approx_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                     rel_err: float = 0.001) -> DataFrame:
    """Same shape as :func:`exact_quantiles` from Greenwald-Khanna sketches (one pass)."""
    spark = df.sparkSession
    cols = list(cols)
    res = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).approxQuantile(cols, list(probs), rel_err)
    rows = []
    for c, vals in zip(cols, res):
        for q, v in zip(probs, vals or [None] * len(probs)):
            rows.append((c, float(q), None if v is None else float(v)))
    schema = T.StructType(list(_QSCHEMA.fields) + [T.StructField("value", T.DoubleType(), True)])
    return spark.createDataFrame(rows, schema)


def quantile_dict(qdf: DataFrame) -> dict[tuple[str, float], float | None]:
    """Collect a quantile table (``len(cols) x len(probs)`` rows) to the driver."""
    return {(r["feature"], float(r["q"])): r["value"] for r in qdf.collect()}
