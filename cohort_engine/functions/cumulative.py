"""Running sums that never put a whole ordered group into one task.

A window ``partitionBy(g).orderBy(x)`` sends every row of group ``g`` to a single
task; with two classes (fold assignment) or no group at all (ROC / PR curves) that
is one task for half or all of the data.  ``running_sum`` instead

1. cuts the order column into range buckets at approximate quantiles (cut points
   are held as literals, so a retried task buckets rows identically),
2. takes the running sum inside each (group, bucket) -- a task sees about
   ``rows / buckets`` rows,
3. adds the exclusive total of all earlier buckets of the group, computed on a
   table of ``groups x buckets`` rows.

The result is exactly the running sum of one big window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohort_engine.functions.partitions import bucket_count

_BUCKET = "__bucket"


#: Quantiles of the pass that counts the rows as well; more buckets than that take a second one.
PROBED = 512


def _cut_points(df: DataFrame, col: str, n_buckets: int | None, rel_err: float) -> list[float]:
    """Inner cut points for ``n_buckets`` ranges, or for as many as the rows ask for."""
    from cohort_engine.functions.quantiles import cut_points
    if n_buckets is None:
        (fine,), rows = cut_points(df, [col], PROBED, rel_err, with_count=True)
        n_buckets = bucket_count(df.sparkSession, rows)
        if n_buckets <= PROBED:
            step = max(1, len(fine) // n_buckets)
            return fine[step - 1::step]
    return cut_points(df, [col], n_buckets, rel_err)[0]


def range_buckets(df: DataFrame, col: str, n_buckets: int | None = None,
                  out_col: str = _BUCKET, rel_err: float = 0.001) -> DataFrame:
    """Add ``out_col``: the index of the approximate-quantile range holding ``col``.

    Bucket order follows the order of ``col``.  Cut points are computed once on the
    driver (``n_buckets - 1`` doubles) and then are literals of the plan.
    """
    if n_buckets is not None and n_buckets <= 1:
        return df.withColumn(out_col, F.lit(0.0))
    tmp = f"{out_col}_src"
    src = df.withColumn(tmp, F.col(col).cast("double"))
    cuts = _cut_points(src, tmp, n_buckets, rel_err)
    splits = [float("-inf")] + cuts + [float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol=tmp, outputCol=out_col,
                          handleInvalid="keep").transform(src)
    return bucketed.drop(tmp)


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"__r_{k}")
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"__r_{k}"])
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, "inner")
    return joined.drop(*[f"__r_{k}" for k in keys])


def running_sum(df: DataFrame, order_cols: Sequence[str | Column], value_cols: Sequence[str],
                partition_cols: Sequence[str] = (), bucket_col: str | None = None,
                n_buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Add ``prefix + v`` = inclusive running sum of each ``v`` in ``value_cols``.

    Order is ``order_cols`` (ties must be broken by the caller if the result should
    be unique per row) within ``partition_cols``.  The first order column must be
    numeric; it defines the range buckets unless ``bucket_col`` is given (a column
    whose order agrees with the order columns inside every partition group).
    """
    order_exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    part = list(partition_cols)
    if bucket_col is None:
        first = order_cols[0]
        if not isinstance(first, str):
            raise ValueError("the first order column must be a column name when buckets are derived")
        df = range_buckets(df, first, n_buckets)
        bucket_col = _BUCKET
        drop_bucket = True
    else:
        drop_bucket = False

    inner = (Window.partitionBy(*part, bucket_col).orderBy(*order_exprs)
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    within = df
    for v in value_cols:
        within = within.withColumn(f"__in_{v}", F.sum(F.col(v)).over(inner))

    totals = df.groupBy(*part, bucket_col).agg(*[F.sum(F.col(v)).alias(f"__t_{v}") for v in value_cols])
    before = (Window.partitionBy(*part).orderBy(bucket_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        *part, bucket_col,
        *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}") for v in value_cols])
    # groups x buckets rows: the runtime sees their bytes and broadcasts them where that is cheap
    joined = _null_safe_join(within, offsets, part + [bucket_col])
    out = joined
    for v in value_cols:
        out = out.withColumn(f"{prefix}{v}", F.col(f"__in_{v}") + F.col(f"__o_{v}"))
    out = out.drop(*[f"__in_{v}" for v in value_cols], *[f"__o_{v}" for v in value_cols])
    if drop_bucket:
        out = out.drop(bucket_col)
    return out
