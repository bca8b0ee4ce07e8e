"""Preprocessing transforms.

Fitted statistics are per-column scalars (``len(cols)`` values, never per row), so
models keep them on the driver and ``transform`` is a single projection with
literals -- one narrow, whole-stage-codegen stage.  The only transforms that move
rows are batch centring (a join with per-batch means) and resampling (a join of
drawn positions with ranked rows).

Statistic scope (reference quirk, kept as the default): z-score and bad-value fill
use the statistics *of the frame being transformed* (``stats='self'``), so a row's
value depends on the other rows scored with it.  ``stats='fit'`` uses the training
frame's statistics instead and is the better choice for scoring new samples.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.functions.cumulative import running_sum
from cohort_engine.functions.expressions import name, number, replace_columns, unfold
from cohort_engine.functions.hashing import hash_order, hash_rest
from cohort_engine.functions.partitions import bucket_count, stored
from cohort_engine.functions.quantiles import exact_quantiles
from cohort_engine.operators.stats import has_negative, to_long

# Size of the 60-bit hash order space (rank buckets are equal slices of it).
_HASH_SPACE = float(16 ** 15)
BROADCAST_CELLS = 500_000          # batches x columns up to which means that were counted are broadcast


@dataclass
class ColumnFacts:
    """What one pass learns of a column: its cells and their moments."""
    n: int = 0                    # non-NULL cells
    logs: int = 0                 # cells whose log2(x + 1) is defined
    mean: float | None = None
    std: float | None = None      # population
    low: float | None = None


def _facts(df: DataFrame, cols: Sequence[str]) -> tuple[dict[str, ColumnFacts], int]:
    """Facts of every column, and the row count, from one long-form aggregate."""
    if not cols:
        return {}, 0
    rows = to_long(df, cols, drop_nulls=False).groupBy("feature").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"), F.count(F.log2(F.col("value") + 1)).alias("logs"),
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), F.min("value").alias("low")).collect()
    facts = {c: ColumnFacts() for c in cols}
    facts |= {r["feature"]: ColumnFacts(r["n"], r["logs"], r["mean"], r["std"], r["low"]) for r in rows}
    return facts, rows[0]["rows"] if rows else 0


def _moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population std per column."""
    return {c: (f.mean, f.std) for c, f in _facts(df, cols)[0].items()}


def _null_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Columns of ``df`` holding at least one NULL (one aggregate)."""
    facts, rows = _facts(df, cols)
    return [c for c in cols if facts[c].n < rows]


def _medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    if not cols:
        return {}
    return {r["feature"]: r["value"] for r in exact_quantiles(df, cols, [0.5]).collect()}


def log2_normalize(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``log2(x + 1)``; x <= -1 gives NULL (the reference's -inf / NaN)."""
    return replace_columns(df, {c: f"log2({name(c)} + CAST(1 AS DOUBLE))" for c in cols})


def zscore_normalize(df: DataFrame, cols: Sequence[str],
                     stats: dict[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """``(x - mean) / std_pop``; zero std gives NULL (filled by T3)."""
    stats = stats if stats is not None else _moments(df, cols)
    out = {}
    for c in cols:
        mean, std = stats.get(c, (None, None))
        out[c] = "CAST(NULL AS DOUBLE)" if mean is None or std is None else f"try_divide({name(c)} - {number(mean)}, {number(std)})"
    return replace_columns(df, out)


def fill_bad(df: DataFrame, cols: Sequence[str], medians: dict[str, float | None] | None = None,
             nullable: Sequence[str] | None = None) -> DataFrame:
    """NULL (NaN, +/-inf at ingest) -> the column median, else 0.0.

    Medians are computed only for the columns that hold a NULL (``nullable``, or
    found by one aggregate); a column without NULLs is left as it is.
    """
    if medians is None:
        nullable = list(nullable) if nullable is not None else _null_columns(df, cols)
        medians = _medians(df, nullable)
        cols = nullable
    fills = {c: f"coalesce({name(c)}, {number(0.0 if medians.get(c) is None else medians[c])})" for c in cols}
    return replace_columns(df, fills) if fills else df


def batch_facts(df: DataFrame, cols: Sequence[str], batch: str) -> DataFrame:
    """``(batch, i, mean, n, var)`` of column ``cols[i]`` in every batch; NULL is a batch."""
    return unfold(df.withColumn("__of_batch", F.col(batch)), cols, ["__of_batch"], index=True).groupBy(
        F.col("__of_batch").alias("batch"), "i").agg(
        F.avg("value").alias("mean"), F.count("value").alias("n"), F.var_pop("value").alias("var"))


def batch_means(facts: DataFrame) -> DataFrame:
    """``(__batch, __means)``: the means of a batch as one array in column order."""
    return (facts.groupBy("batch").agg(F.array_sort(F.collect_list(F.struct("i", "mean"))).alias("means"))
            .select(F.col("batch").alias("__batch"), F.transform("means", lambda x: x["mean"]).alias("__means")))


def subtract_means(df: DataFrame, cols: Sequence[str], batch: str, means: DataFrame) -> DataFrame:
    joined = df.join(means, F.col(batch).eqNullSafe(F.col("__batch")), "left")
    # a batch the means do not know stays as it is
    centred = {c: f"CAST({name(c)} AS DOUBLE) - coalesce(__means[{i}], CAST(0 AS DOUBLE))" for i, c in enumerate(cols)}
    return replace_columns(joined, centred).drop("__batch", "__means")


def batch_center(df: DataFrame, cols: Sequence[str], batch: str = "batch", with_moments: bool = False):
    """T4: subtract each feature's mean within its batch; NULL batch is a batch.

    Per-batch means are aggregated map-side into one row of means per batch, which is
    joined.  No hint is given: the runtime sees the bytes of the means and broadcasts
    them, or joins by shuffle and splits a skewed batch.  With moments the means are counted
    before the join, and few of them are broadcast, so that no row moves by its batch.

    With ``with_moments`` also returns ``{col: (mean, population std)}`` of the
    centred values -- mean 0 and the pooled within-batch spread, from the same
    facts -- so a scaler fitted next needs no pass of its own.
    """
    if batch not in df.columns or not cols:
        return (df, None) if with_moments else df
    facts = batch_facts(df, cols, batch)
    if not with_moments:
        return subtract_means(df, cols, batch, batch_means(facts))
    facts = facts.checkpoint()                   # batches x columns rows, read twice
    pooled = facts.groupBy("i").agg(F.try_divide(F.sum(F.col("n") * F.col("var")), F.sum("n")).alias("v"), F.count(F.lit(1)).alias("cells")).collect()
    means = batch_means(facts)
    out = subtract_means(df, cols, batch, F.broadcast(means) if sum(r["cells"] for r in pooled) <= BROADCAST_CELLS else means)
    spread = {cols[r["i"]]: None if r["v"] is None else r["v"] ** 0.5 for r in pooled}
    return out, {c: (0.0, spread.get(c)) for c in cols}


def correct_batches(df: DataFrame, cols: Sequence[str], batches: DataFrame, id_col: str = "patient_id") -> DataFrame:
    """T5: batch correction on its own, with the batches in a table ``(id, batch)`` beside the features."""
    key, batch = (F.col(c) for c in batches.columns[:2])
    side = batches.select(key.alias("__id"), batch.alias("__of"))
    joined = df.join(side, F.col(id_col).eqNullSafe(F.col("__id")), "left").drop("__id")
    return batch_center(joined, cols, "__of").drop("__of")


@dataclass
class NormalizerModel:
    """Fitted log2-or-z-score normaliser (T1/T2 + T3 + T4)."""
    cols: list[str]
    use_zscore: bool
    batch_col: str | None = "batch"
    stats: str = "self"
    fit_moments: dict = field(default_factory=dict)
    fit_medians: dict = field(default_factory=dict)

    def normalize(self, df: DataFrame, moments=None) -> DataFrame:
        if self.use_zscore:
            return zscore_normalize(df, self.cols, moments)
        return log2_normalize(df, self.cols)

    def transform(self, df: DataFrame) -> DataFrame:
        own = self.stats == "self"
        if not own:
            out = fill_bad(self.normalize(df, self.fit_moments), self.cols, self.fit_medians)
        elif self.use_zscore:
            facts, rows = _facts(df, self.cols)
            out = self.normalize(df, {c: (f.mean, f.std) for c, f in facts.items()})
            # a z-score is NULL where the cell is NULL or the column has no spread
            out = fill_bad(out, self.cols, nullable=[c for c, f in facts.items() if f.n < rows or not f.std])
        else:
            out = fill_bad(self.normalize(df), self.cols)
        if self.batch_col and self.batch_col in df.columns:
            out = batch_center(out, self.cols, self.batch_col)
        return out


class FrozenNormalizer:
    """A normaliser whose statistics are those of one given frame, whatever it transforms."""

    def __init__(self, model: NormalizerModel, df: DataFrame):
        self.model = model
        facts, _ = _facts(df, model.cols)
        self.moments = {c: (f.mean, f.std) for c, f in facts.items()} if model.stats == "self" else model.fit_moments
        normed = model.normalize(df, self.moments)
        self.medians = _medians(normed, model.cols) if model.stats == "self" else model.fit_medians
        self.means = None
        if model.batch_col and model.batch_col in df.columns:
            filled = fill_bad(normed, model.cols, self.medians)
            self.means = stored(batch_means(batch_facts(filled, model.cols, model.batch_col)))

    def transform(self, df: DataFrame) -> DataFrame:
        m = self.model
        out = fill_bad(m.normalize(df, self.moments), m.cols, self.medians)
        return out if self.means is None else subtract_means(out, m.cols, m.batch_col, self.means)


@dataclass
class Normalizer:
    """T1-T4 as an estimator: learns only whether any training cell is negative.

    Negative cells anywhere -> z-score, else log2(x + 1); then bad-value fill, then
    batch-mean centring when the batch column is present.
    """
    cols: list[str]
    batch_col: str | None = "batch"
    stats: str = "self"

    def fit_transform(self, df: DataFrame) -> tuple[NormalizerModel, DataFrame]:
        """Fit and transform the same frame with one statistics pass: the sign test,
        the z-score moments and the NULL counts of both branches come together."""
        if self.stats != "self" or not self.cols:
            model = self.fit(df)
            return model, model.transform(df)
        facts, rows = _facts(df, self.cols)
        use_z = any(f.low is not None and f.low < 0 for f in facts.values())
        model = NormalizerModel(self.cols, use_z, self.batch_col, self.stats)
        if use_z:
            out = zscore_normalize(df, self.cols, {c: (f.mean, f.std) for c, f in facts.items()})
            nullable = [c for c, f in facts.items() if f.n < rows or not f.std]
        else:
            out = log2_normalize(df, self.cols)
            nullable = [c for c, f in facts.items() if f.logs < rows]
        out = fill_bad(out, self.cols, nullable=nullable)
        self.out_moments = None
        if self.batch_col and self.batch_col in df.columns:
            out, self.out_moments = batch_center(out, self.cols, self.batch_col, with_moments=True)
        return model, out

    def fit(self, df: DataFrame) -> NormalizerModel:
        use_z = has_negative(df, self.cols)
        model = NormalizerModel(self.cols, use_z, self.batch_col, self.stats)
        if self.stats == "fit":
            model.fit_moments = _moments(df, self.cols) if use_z else {}
            normed = model.normalize(df, model.fit_moments)
            model.fit_medians = _medians(normed, self.cols)
        return model


@dataclass
class ScalerModel:
    cols: list[str]
    means: dict[str, float]
    scales: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: f"({name(c)} - {number(self.means[c])}) / {number(self.scales[c])}" for c in self.cols})


@dataclass
class StandardScaler:
    """Mean / population std; a zero (or undefined) std scales by 1.

    ``pyspark.ml.feature.StandardScaler`` divides by the sample std, so the
    statistics are computed here.
    """
    cols: list[str]

    def fit(self, df: DataFrame) -> ScalerModel:
        st = _moments(df, self.cols)
        means = {c: float(st[c][0]) if st[c][0] is not None else 0.0 for c in self.cols}
        scales = {c: float(st[c][1]) if st[c][1] not in (None, 0.0) else 1.0 for c in self.cols}
        return ScalerModel(list(self.cols), means, scales)


@dataclass
class ImputerModel:
    cols: list[str]
    medians: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: f"coalesce({name(c)}, {number(self.medians[c])})" for c in self.cols}) if self.cols else df


@dataclass
class MedianImputer:
    """Exact fitted medians (``ml.feature.Imputer`` uses a sketch).

    An all-NULL column keeps its NULLs, as the reference's imputer drops it.
    """
    cols: list[str]

    def fit(self, df: DataFrame) -> ImputerModel:
        med = _medians(df, self.cols)
        kept = [c for c in self.cols if med.get(c) is not None]
        return ImputerModel(kept, {c: float(med[c]) for c in kept})


# ---------------------------------------------------------------------------
# resampling
# ---------------------------------------------------------------------------

def rank_in_class(df: DataFrame, label: str, id_col: str, seed: int = 42, out: str = "__rank",
                  n_rows: int | None = None) -> DataFrame:
    """0-based position of each row inside its class in ``md5(seed:id)`` order.

    A running count in hash-range buckets: the hash is uniform, so bucket bounds
    are arithmetic and every bucket holds about ``rows / buckets`` rows, even when
    one class holds most rows.
    """
    n_buckets = bucket_count(df.sparkSession, df.count() if n_rows is None else n_rows)
    keyed = (df.withColumn("__h", hash_order(seed, id_col))
             .withColumn("__hk", hash_rest(seed, id_col))
             .withColumn("__one", F.lit(1))
             .withColumn("__hb", F.floor(F.col("__h") / F.lit(_HASH_SPACE / n_buckets))))
    ranked = running_sum(keyed, ["__h", "__hk", id_col], ["__one"], partition_cols=[label], bucket_col="__hb")
    return ranked.withColumn(out, F.col("cum___one") - 1).drop("__h", "__hk", "__one", "__hb", "cum___one")


def _draws(df: DataFrame, label: str, counts: dict, seed: int) -> DataFrame | None:
    """``(__dl, __pick)``: class and rank of every row drawn to top the smaller classes up (None: nothing to draw).

    Draw ``i`` of class ``c`` takes the row at rank ``md5(seed:draw:c:i) mod n_c``."""
    n_max = max(counts.values())
    extra = {c: n_max - n for c, n in counts.items() if n < n_max}
    draws = None
    parts = bucket_count(df.sparkSession, sum(extra.values()))
    for c, k in extra.items():
        d = (df.sparkSession.range(0, k, 1, parts)
             .select(F.lit(c).cast(df.schema[label].dataType).alias("__dl"),
                     (hash_order(seed, F.lit("draw"), F.lit(str(c)), F.col("id")) % F.lit(counts[c]))
                     .alias("__pick")))
        draws = d if draws is None else draws.unionByName(d)
    return draws


def _class_counts(df: DataFrame, label: str) -> dict:
    return {r[0]: r[1] for r in df.groupBy(label).count().collect()}   # one row per class


def oversample(df: DataFrame, label: str = "response", id_col: str = "patient_id", seed: int = 42) -> DataFrame:
    """Every class but the largest is topped up to the largest class size by
    drawing its rows with replacement; the original rows are kept.

    Only the training side of a split may be passed in (resampling before the
    fold split would leak copies into validation).  ``resample_weights`` gives the
    same draws as numbers instead of copies.
    """
    counts = _class_counts(df, label)
    draws = _draws(df, label, counts, seed) if len(counts) > 1 else None
    if draws is None:
        return df
    ranked = rank_in_class(df, label, id_col, seed, n_rows=sum(counts.values()))
    minority = ranked.where(F.col(label).isin([c for c, n in counts.items() if n < max(counts.values())]))
    # no hint: the runtime broadcasts a minority of few bytes, whose few join keys could not be spread
    copies = draws.join(minority, (draws["__dl"] == minority[label]) & (draws["__pick"] == minority["__rank"]), "inner")
    return df.unionByName(copies.select(*df.columns))


def resample_weights(df: DataFrame, strategy: str, label: str = "response", id_col: str = "patient_id", seed: int = 42, out: str = "weight") -> DataFrame:
    """T8, T9 as multiplicities: every row with the number of times the resampled table holds it (left out: 0 times).

    Draws are counted by rank before they meet the rows, so a row is one row however often it is drawn; statistics and
    estimators take the number as a weight."""
    kind = {"oversampling": "over", "over": "over", "undersampling": "under", "under": "under", "none": None, None: None}
    if strategy not in kind:
        raise ValueError(f"unknown resampling strategy '{strategy}'")
    counts = _class_counts(df, label) if kind[strategy] else {}
    if len(counts) < 2:
        return df.withColumn(out, F.lit(1).cast("long"))
    if kind[strategy] == "under":
        ranked = rank_in_class(df, label, id_col, seed, n_rows=sum(counts.values()))
        return ranked.where(F.col("__rank") < min(counts.values())).drop("__rank").withColumn(out, F.lit(1).cast("long"))
    draws = _draws(df, label, counts, seed)
    if draws is None:
        return df.withColumn(out, F.lit(1).cast("long"))
    ranked = rank_in_class(df, label, id_col, seed, n_rows=sum(counts.values()))
    times = draws.groupBy("__dl", "__pick").agg(F.count(F.lit(1)).alias("__times"))
    met = ranked.join(times, (ranked[label] == times["__dl"]) & (ranked["__rank"] == times["__pick"]), "left")
    return met.withColumn(out, F.lit(1) + F.coalesce("__times", F.lit(0))).drop("__dl", "__pick", "__times", "__rank")


def undersample(df: DataFrame, label: str = "response", id_col: str = "patient_id", seed: int = 42) -> DataFrame:
    """Every class is cut to the smallest class size, keeping the first rows in
    ``md5(seed:id)`` order (no replacement)."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}
    if len(counts) < 2:
        return df
    n_min = min(counts.values())
    ranked = rank_in_class(df, label, id_col, seed, n_rows=sum(counts.values()))
    return ranked.where(F.col("__rank") < n_min).drop("__rank")


def resample(df: DataFrame, strategy: str, label: str = "response", id_col: str = "patient_id",
             seed: int = 42) -> DataFrame:
    if strategy in ("oversampling", "over"):
        return oversample(df, label, id_col, seed)
    if strategy in ("undersampling", "under"):
        return undersample(df, label, id_col, seed)
    if strategy in ("none", None):
        return df
    raise ValueError(f"unknown resampling strategy '{strategy}'")
