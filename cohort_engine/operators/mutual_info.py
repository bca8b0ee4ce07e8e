"""Mutual information between each continuous feature and a discrete class (F2).

The k-nearest-neighbour estimator (k = 3) for a continuous variable and a
discrete one (Ross 2014): for every point with at least one class mate,

* r = distance to its k-th nearest class mate (k = min(3, n_c - 1));
* m = number of points of any class strictly closer than r (itself included; when
  r = 0, the points equal to it);

MI = psi(N) + mean psi(k) - mean psi(n_c) - mean psi(m), floored at 0.

Everything runs on **distinct values with multiplicities** -- a value held by a
third of a column is one row -- and in one dimension:

1. per (feature, class) the distinct values are ranked by a bucketed running
   count (never one window per feature);
2. a value with multiplicity c has c - 1 class mates at distance 0; the remaining
   k - c + 1 nearest lie among the k nearest distinct values on each side, taken from
   the sorted bucket, and past its edges by an equi-join on ``rank +/- j`` of the few
   values there; r is where the cumulative multiplicity, in distance order, reaches them;
3. m comes from a running count over (distinct values of all classes  U  probe
   values), probes ordered before (``<``) or after (``<=``) equal values; on the
   neighbour's side the probe is the neighbour's own value, so no ``x +/- r``
   rounding enters there;
4. every term is weighted by the multiplicity.

Resampled copies (repeated ids) are separate points at distance 0, as in the
reference.  No random jitter is added (the estimate is deterministic).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohort_engine.functions.cumulative import _BUCKET, range_buckets, running_sum
from cohort_engine.functions.digamma import digamma_int
from cohort_engine.operators.stats import to_long

N_NEIGHBORS = 3


def _order_key(df: DataFrame, cols: Sequence[str], mm: dict) -> DataFrame:
    """A single numeric key ordering rows by (feature, value): feature index plus
    the value scaled into [0, 0.5] by the feature's min / max (``len(cols)`` rows
    of statistics).  Range buckets on it split every feature by its own values."""
    idx, lo, span = [], [], []
    for i, c in enumerate(cols):
        a, b = mm.get(c, (0.0, 0.0))
        idx += [F.lit(c), F.lit(float(i))]
        lo += [F.lit(c), F.lit(float(a or 0.0))]
        span += [F.lit(c), F.lit(float((b - a) if (a is not None and b is not None and b > a) else 1.0))]
    f = F.col("feature")
    scaled = (F.col("value") - F.element_at(F.create_map(*lo), f)) / F.element_at(F.create_map(*span), f)
    return df.withColumn("__key", F.element_at(F.create_map(*idx), f)
                         + F.least(F.greatest(scaled, F.lit(0.0)), F.lit(1.0)) * 0.5)


def mutual_info(df: DataFrame, cols: Sequence[str], label: str = "response", id_col: str = "patient_id",
                n_neighbors: int = N_NEIGHBORS, weight: str | None = None) -> DataFrame:
    """``(feature, mi)`` for every column (NULL cells are skipped).  ``id_col`` is
    not needed: points are identified by their value and counted with multiplicity;
    with ``weight``, a row counts that many times."""
    spark = df.sparkSession
    cols = list(cols)
    K = n_neighbors
    long = to_long(df, cols, keys=[label, *([weight] if weight else [])]).withColumnRenamed(label, "__y")
    # distinct values per (feature, class) with multiplicity: map-side pre-aggregation
    dv = long.groupBy("feature", "__y", "value").agg((F.sum(F.col(weight)) if weight else F.count(F.lit(1))).alias("c"))
    n_c = dv.groupBy("feature", "__y").agg(F.sum("c").alias("n_c"))
    # classes x features rows; the class column of a 0/1 response has few values
    dv = (dv.join(F.broadcast(n_c), ["feature", "__y"]).where(F.col("n_c") > 1)
          .withColumn("k", F.least(F.lit(K), F.col("n_c") - 1))).persist()
    mm = {r["feature"]: (r["lo"], r["hi"]) for r in
          dv.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi")).collect()}

    # ranks and, in the same sorted buckets, the k values before and after each value
    bucketed = range_buckets(_order_key(dv, cols, mm).withColumn("__one", F.lit(1)), "__key")
    order = Window.partitionBy("feature", "__y", _BUCKET).orderBy("__key", "value")
    held = F.struct(F.col("value").alias("nv"), F.col("c").alias("nc"))
    steps = {j: F.lag(held, -j) if j < 0 else F.lead(held, j) for j in range(-K, K + 1) if j}
    bucketed = bucketed.withColumns({f"__at{j}": f.over(order) for j, f in steps.items()})
    ranked = running_sum(bucketed, ["__key", "value"], ["__one"], partition_cols=["feature", "__y"], bucket_col=_BUCKET)

    def found(j, at: Column) -> Column:
        return F.struct(F.abs(at["nv"] - F.col("value")).alias("d"), j.alias("j"), at["nv"].alias("nv"), at["nc"].alias("nc"))

    ranked = ranked.select("feature", "__y", "value", "c", "k", "n_c", (F.col("cum___one") - 1).alias("rank"),
                           F.array_compact(F.array(*[F.when(F.col(f"__at{j}").isNotNull(), found(F.lit(j), F.col(f"__at{j}"))) for j in steps])).alias("cands"),
                           F.array_compact(F.array(*[F.when(F.col(f"__at{j}").isNull(), F.lit(j)) for j in steps])).alias("missing")).persist()
    # what a bucket's edge hides lies at the edges of the buckets beside it: at most 2k values a bucket, feature and class
    edges = ranked.where((F.array_min("missing") == -K) | (F.array_max("missing") == K))
    asked = edges.select("feature", "__y", "value", "rank", F.explode("missing").alias("j")).withColumn("nr", F.col("rank") + F.col("j"))
    there = edges.select("feature", "__y", F.col("rank").alias("nr"), held.alias("at"))
    more = (asked.join(there, ["feature", "__y", "nr"]).groupBy("feature", "__y", "value")
            .agg(F.collect_list(found(F.col("j"), F.col("at"))).alias("more")))           # at most 2k entries
    whole = (edges.join(more, ["feature", "__y", "value"], "left")
             .withColumn("cands", F.when(F.col("more").isNull(), F.col("cands")).otherwise(F.concat("cands", "more"))))
    kept = ["feature", "__y", "value", "c", "k", "n_c", "cands"]
    inner = ranked.where("size(missing) = 0")
    per = inner.select(*kept).unionByName(whole.select(*kept)).withColumn("cands", F.sort_array("cands"))
    need = F.col("k") - F.col("c") + 1
    hit_type = "struct<cum:bigint,d:double,j:int,nv:double>"
    walk = F.aggregate(
        "cands",
        F.struct(F.lit(0).cast("long").alias("cum"), F.lit(None).cast("double").alias("d"),
                 F.lit(None).cast("int").alias("j"), F.lit(None).cast("double").alias("nv")).cast(hit_type),
        lambda acc, x: F.when(acc["d"].isNull() & (acc["cum"] + x["nc"] >= need),
                              F.struct((acc["cum"] + x["nc"]).alias("cum"), x["d"].alias("d"), x["j"].alias("j"),
                                       x["nv"].alias("nv")))
        .otherwise(F.struct((acc["cum"] + x["nc"]).alias("cum"), acc["d"].alias("d"), acc["j"].alias("j"),
                            acc["nv"].alias("nv"))).cast(hit_type))
    per = per.withColumn("__hit", F.when(need <= 0, F.lit(None)).otherwise(walk))
    per = per.select("feature", "__y", "value", "c", "k", "n_c",
                     F.coalesce(F.col("__hit.d"), F.lit(0.0)).alias("r"),
                     F.col("__hit.j").alias("side"), F.col("__hit.nv").alias("nv"))
    # probes: (value, kind) with kind 0 = counted strictly below, 2 = at or below
    up = F.when(F.col("r") == 0, F.struct(F.col("value").alias("pv"), F.lit(2).alias("kind"))) \
        .when(F.col("side") > 0, F.struct(F.col("nv").alias("pv"), F.lit(0).alias("kind"))) \
        .otherwise(F.struct((F.col("value") + F.col("r")).alias("pv"), F.lit(0).alias("kind")))
    down = F.when(F.col("r") == 0, F.struct(F.col("value").alias("pv"), F.lit(0).alias("kind"))) \
        .when(F.col("side") < 0, F.struct(F.col("nv").alias("pv"), F.lit(2).alias("kind"))) \
        .otherwise(F.struct((F.col("value") - F.col("r")).alias("pv"), F.lit(2).alias("kind")))
    # a value's two probes run with the points; above less below is m, mostly added up where both were counted
    sides = F.array(F.struct(up.alias("p"), F.lit(1).alias("sign")), F.struct(down.alias("p"), F.lit(-1).alias("sign")))
    own = ["__y", "c", "k", "n_c"]
    probes = (per.select("feature", F.col("value").alias("of"), *own, F.explode(sides).alias("s"))
              .select("feature", "of", *own, "s.sign", F.col("s.p.pv").alias("value"), F.col("s.p.kind").alias("kind"), F.lit(0).cast("long").alias("cnt")))
    points = dv.select("feature", "value", F.lit(1).alias("kind"), F.col("c").alias("cnt"))
    merged = _order_key(probes.unionByName(points, allowMissingColumns=True), cols, mm).persist()
    counted = running_sum(merged, ["__key", "value", "kind"], ["cnt"], partition_cols=["feature"])
    withm = (counted.where(F.col("kind") != 1).groupBy("feature", "of", *own)
             .agg(F.sum(F.col("sign") * F.col("cum_cnt")).alias("m")))
    cw = F.col("c").cast("double")
    agg = withm.groupBy("feature").agg(
        F.sum("c").alias("big_n"),
        (F.sum(cw * digamma_int(F.col("k"))) / F.sum(cw)).alias("pk"),
        (F.sum(cw * digamma_int(F.col("n_c"))) / F.sum(cw)).alias("pn"),
        (F.sum(cw * digamma_int(F.col("m"))) / F.sum(cw)).alias("pm"))
    mi = agg.select("feature", F.greatest(F.lit(0.0), digamma_int(F.col("big_n")) + F.col("pk") - F.col("pn")
                                          - F.col("pm")).alias("mi"))
    got = {r["feature"]: r["mi"] for r in mi.collect()}                 # one row per column
    for cached in (dv, ranked, merged):
        cached.unpersist()
    rows = [(c, float(got.get(c) or 0.0)) for c in cols]
    return spark.createDataFrame(rows, T.StructType([T.StructField("feature", T.StringType()),
                                                     T.StructField("mi", T.DoubleType())]))
