"""Grid search and nested stratified cross-validation.

Layout of the work, per seed:

* outer folds are assigned once (stratified, ``md5(seed:id)`` order) and the
  fold table is checkpointed to the shared checkpoint folder, so a lost executor
  does not replay the cohort joins;
* for every (outer) split, the inner grid search assigns inner folds on the
  training rows; for every inner split the preparation chain, resampling and the
  feature ranking are fitted **once** and shared by all candidates (the reference
  refits them per candidate);
* resampling gives every training row the number of times it is drawn; ranking and
  estimators take it as a weight, nothing is copied;
* logistic regressions of all candidates are fitted together, one pass a Newton step
  (``multi_fit``); other candidate fits are Spark jobs submitted from a small driver
  thread pool, whose validation predictions are unioned and scored by one grouped job;
* one outer pass yields the fold MCCs (G4), the out-of-fold classes (G5) and the
  out-of-fold probabilities (G6) -- the reference runs that pass three times.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohort_engine.functions.partitions import right_size
from cohort_engine.operators import metrics as M
from cohort_engine.operators import prep as P
from cohort_engine.operators import select as S
from cohort_engine.operators import stats as A
from cohort_engine.plans import lasso_path as LP
from cohort_engine.plans import models as MD
from cohort_engine.plans import multi_fit as MF
from cohort_engine.plans.folds import stratified_folds
from cohort_engine.plans.ledger import WHOLE, SearchLedger, as_json
from cohort_engine.plans.pipeline_prep import PreparedModel, Preparer
from cohort_engine.session import drop_unreferenced, ensure_checkpoint_dir, files_dropped


WEIGHT = "__weight"       # how often the resampled training rows hold a row
RESAMPLE_SEED = 42       # fixed value: the reference resamples with it whatever the run's seed


@dataclass
class SearchConfig:
    algorithm: str
    selection: str = "anova"
    response: str = "response"
    id_col: str = "patient_id"
    batch_col: str | None = "batch"
    outer_folds: int = 10
    inner_folds: int = 10
    resampling: str = "auto"             # auto (reference rule) | over | under | none
    outlier_method: str | None = None
    outlier_params: dict = field(default_factory=dict)
    k_values: list[int] | None = None
    grid: list[dict] | None = None
    stats: str = "self"
    parallelism: int = 4

    def candidates(self, n_features: int) -> list[dict]:
        if self.grid is not None:
            return list(self.grid)
        ks = self.k_values or S.k_range(n_features)
        return MD.param_grid(S.select_method(self.selection), self.algorithm, ks)


@dataclass
class Split:
    """Prepared training / validation frames of one split, ranked features and sizes."""
    prep: PreparedModel
    ranking: list[str]                   # features in selection order (anova / mi / rfe)
    train: DataFrame                     # id, label, features (all kept features, ranked order)
    val: DataFrame | None
    n_train: int
    cached: list[DataFrame]

    def release(self):
        """Drop the stored rows, and with the last references to them the shuffle files behind them."""
        spark = self.train.sparkSession
        for d in self.cached:
            d.unpersist()
        self.cached.clear()
        self.train = self.val = None
        drop_unreferenced(spark)


def _persist(df: DataFrame, bag: list[DataFrame]) -> DataFrame:
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    bag.append(df)
    return df


def decide_resampling(df: DataFrame, cfg: SearchConfig) -> str:
    if cfg.resampling != "auto":
        return cfg.resampling
    return A.class_balance(df, cfg.response).first()["strategy"]


def _rank(train: DataFrame, feats: list[str], cfg: SearchConfig) -> list[str]:
    if cfg.selection == "anova":
        return S.anova_ranking(train, feats, cfg.response, WEIGHT)
    if cfg.selection == "mutual_info":
        from cohort_engine.operators.mutual_info import mutual_info
        return S.ranked(mutual_info(train, feats, cfg.response, weight=WEIGHT), "mi")
    if cfg.selection == "rfe":
        return S.rfe_path(train, feats, cfg.response, weight=WEIGHT)
    return list(feats)                    # lasso chooses per alpha


def prepare_split(train_raw: DataFrame, val_raw: DataFrame | None, features: list[str], cfg: SearchConfig,
                  strategy: str, seed: int) -> Split:
    bag: list[DataFrame] = []
    preparer = Preparer(features, cfg.batch_col, cfg.stats, cfg.outlier_method, cfg.outlier_params)
    prep, train = preparer.fit(train_raw)
    feats = prep.kept
    train = P.resample_weights(train, strategy, cfg.response, cfg.id_col, RESAMPLE_SEED, WEIGHT)
    train = _persist(train.select(cfg.id_col, cfg.response, WEIGHT, *feats), bag)
    n_rows, n_train = train.agg(F.count(F.lit(1)), F.coalesce(F.sum(WEIGHT), F.lit(0))).first()
    ranking = _rank(train, feats, cfg)
    assembler = VectorAssembler(inputCols=ranking, outputCol="features")

    def vec(d: DataFrame) -> DataFrame:
        return assembler.transform(d.withColumn("label", F.col(cfg.response).cast("double"))) \
            .select(cfg.id_col, "label", "features", *([WEIGHT] if WEIGHT in d.columns else []))

    tr = _persist(right_size(vec(train), n_rows), bag)
    va = None
    if val_raw is not None:
        va = _persist(right_size(vec(prep.transform(val_raw).select(cfg.id_col, cfg.response, *feats)), n_rows),
                      bag)
    preparer.release()
    return Split(prep, ranking, tr, va, n_train, bag)


def _sliced(df: DataFrame, idx: list[int]) -> DataFrame:
    if not idx:
        return df
    return VectorSlicer(inputCol="features", outputCol="__fs", indices=idx).transform(df) \
        .drop("features").withColumnRenamed("__fs", "features")


def _lasso_sets(split: Split, alphas: list[float]) -> dict[float, list[int]]:
    """Features that the lasso keeps at each strength, all from one pass of sums; beyond the columns whose products
    fit, by a solver run for each strength."""
    if len(split.ranking) > LP.MAX_FEATURES:
        from pyspark.ml.regression import LinearRegression
        out = {}
        for a in alphas:
            lr = LinearRegression(featuresCol="features", labelCol="label", weightCol=WEIGHT, regParam=a, elasticNetParam=1.0,
                                  standardization=False, maxIter=10_000, tol=1e-6)
            out[a] = [i for i, w in enumerate(lr.fit(split.train).coefficients.toArray()) if abs(w) > LP.SELECTED]
        return out
    rows = split.train.select(vector_to_array("features").alias("x"), F.col("label").alias("y"), F.col(WEIGHT).cast("double").alias("w"), F.lit(0).alias("fold"))
    paths = LP.lasso_paths(rows, len(split.ranking), alphas)
    return {a: [i for i, w in enumerate(paths[LP.ALL, a]) if abs(w) > LP.SELECTED] for a in alphas}


def _indices(split: Split, params: dict, lasso: dict) -> list[int] | None:
    if "k" in params:
        return list(range(min(int(params["k"]), len(split.ranking))))
    if "alpha" in params:
        idx = lasso[float(params["alpha"])]
        return idx or None                # nothing selected: candidate cannot be fitted
    return list(range(len(split.ranking)))


def fit_candidate(split: Split, params: dict, cfg: SearchConfig, seed: int, lasso: dict, calibrate: bool = True):
    idx = _indices(split, params, lasso)
    if idx is None:
        return None, None
    model = MD.fit(cfg.algorithm, params, _sliced(split.train, idx), split.n_train, seed=seed,
                   calibrate=calibrate, weight=WEIGHT)
    return model, idx


def score_candidates(split: Split, cands: list[dict], cfg: SearchConfig, seed: int) -> dict[int, tuple]:
    """Fit every candidate on the split's training rows; (mcc, f1, rows) on its validation rows."""
    if MD.canonical(cfg.algorithm) == "logistic_regression" and all("k" in c for c in cands) and len(split.ranking) <= MF.MAX_FEATURES:
        return score_together(split, cands)
    alphas = sorted({float(c["alpha"]) for c in cands if "alpha" in c})
    lasso = _lasso_sets(split, alphas) if alphas else {}

    def one(ci):
        model, idx = fit_candidate(split, cands[ci], cfg, seed, lasso, calibrate=False)
        if model is None:
            return None
        return model.transform(_sliced(split.val, idx)).select(F.lit(ci).alias("cand"), "label", "prediction")

    with ThreadPoolExecutor(max_workers=max(1, cfg.parallelism)) as pool:
        preds = [p for p in pool.map(one, range(len(cands))) if p is not None]
    if not preds:
        return {}
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    # candidates x classes^2 counts: one aggregate, finished on the driver
    cells: dict[int, dict] = {}
    for r in allp.groupBy("cand", "label", "prediction").count().collect():
        cells.setdefault(r["cand"], {})[(r["label"], r["prediction"])] = r["count"]
    return {ci: (*M.scores_from_counts(cc)[:2], sum(cc.values())) for ci, cc in cells.items()}


def score_together(split: Split, cands: list[dict]) -> dict[int, tuple]:
    """All logistic regressions of a split in one pass a step, and one pass over its validation rows."""
    own = [MF.Candidate(float(c["C"]), min(int(c["k"]), len(split.ranking))) for c in cands]
    x = vector_to_array("features").alias("x")
    fits = MF.multi_fit_lr(split.train.select("label", x, F.array(F.col(WEIGHT).cast("double")).alias("w")), own)
    counts = MF.fit_counts(split.val.select("label", x), fits)
    return {i: (*M.scores_from_counts(c)[:2], sum(c.values())) for i, c in counts.items() if c}


def usable_features(df: DataFrame, features: list[str], cfg: SearchConfig) -> int:
    """Features left by the outlier screen, from which the k values are made."""
    if not cfg.outlier_method or cfg.k_values is not None or cfg.grid is not None:
        return len(features)
    preparer = Preparer(features, cfg.batch_col, cfg.stats, cfg.outlier_method, cfg.outlier_params)
    try:
        return len(preparer.fit(df)[0].kept)
    finally:
        preparer.release()


def _add(sums: dict, scores: dict[int, tuple]) -> None:
    for ci, (mcc, f1, _) in scores.items():
        sums[ci][0] += mcc
        sums[ci][1] += f1
        sums[ci][2] += 1


def grid_search(df: DataFrame, features: list[str], cfg: SearchConfig, strategy: str, seed: int,
                ledger: SearchLedger | None = None, outer: int = WHOLE) -> dict:
    """Mean inner-fold MCC and weighted F1 per candidate; refit choice = best MCC,
    first candidate on ties.  Returns {'best': params, 'table': [(params, mcc, f1)]}.
    With a ``ledger``, splits it holds are not fitted again."""
    cands = cfg.candidates(usable_features(df, features, cfg))
    inner = stratified_folds(df, cfg.response, cfg.id_col, cfg.inner_folds, seed, out="__inner")
    inner = inner.persist(StorageLevel.MEMORY_AND_DISK)
    sums = {i: [0.0, 0.0, 0] for i in range(len(cands))}
    try:
        for f in range(cfg.inner_folds):
            res = ledger.known(seed, outer, f, cands) if ledger else None
            if res is not None:
                _add(sums, res)
                continue
            split = prepare_split(inner.where(F.col("__inner") != f).drop("__inner"),
                                  inner.where(F.col("__inner") == f).drop("__inner"),
                                  features, cfg, strategy, seed)
            try:
                res = score_candidates(split, cands, cfg, seed)
            finally:
                split.release()
            if ledger:
                ledger.record(seed, outer, f, cands, res)
            _add(sums, res)
    finally:
        inner.unpersist()
    table = []
    for ci, c in enumerate(cands):
        s = sums[ci]
        full = s[2] == cfg.inner_folds
        table.append((c, s[0] / s[2] if full else None, s[1] / s[2] if full else None))
    best_i = None
    for i, (_, mcc, _) in enumerate(table):
        if mcc is not None and (best_i is None or mcc > table[best_i][1]):
            best_i = i
    if best_i is None:
        raise ValueError("no candidate could be fitted on every inner fold")
    return {"best": table[best_i][0], "table": table}


@dataclass
class TrainedPipeline:
    """The refit best pipeline -- preparation, selected features and model."""
    prep: PreparedModel
    features: list[str]                  # selected, in model input order
    model: MD.FittedModel
    params: dict
    response: str = "response"
    id_col: str = "patient_id"

    def assemble(self, df: DataFrame) -> DataFrame:
        prepared = self.prep.transform(df)
        return VectorAssembler(inputCols=self.features, outputCol="features").transform(prepared)

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``p1`` to the prepared rows."""
        return self.model.transform(self.assemble(df))

    def score(self, prepared: DataFrame) -> DataFrame:
        """Adds ``prediction`` and ``p1`` to rows that are prepared already."""
        return self.model.transform(VectorAssembler(inputCols=self.features, outputCol="features").transform(prepared))


def refit(df: DataFrame, features: list[str], params: dict, cfg: SearchConfig, strategy: str,
          seed: int) -> TrainedPipeline:
    split = prepare_split(df, None, features, cfg, strategy, seed)
    try:
        lasso = _lasso_sets(split, [float(params["alpha"])]) if "alpha" in params else {}
        model, idx = fit_candidate(split, params, cfg, seed, lasso)
        if model is None:
            raise ValueError(f"candidate {params} selects no feature")
        names = [split.ranking[i] for i in idx]
    finally:
        split.release()
    return TrainedPipeline(split.prep, names, model, params, cfg.response, cfg.id_col)


def nested_cv(df: DataFrame, features: list[str], cfg: SearchConfig, seed: int = 42, ledger: SearchLedger | None = None) -> dict:
    """G4-G6 for one seed: per outer fold the inner grid search, the refit and the
    validation predictions.  Returns fold metrics, OOF predictions, chosen params.
    With a ``ledger``, outer folds and splits it holds are not fitted again."""
    ensure_checkpoint_dir(df.sparkSession)
    with files_dropped(df.sparkSession):
        return _nested_cv(df, features, cfg, seed, ledger)


def _nested_cv(df: DataFrame, features: list[str], cfg: SearchConfig, seed: int, ledger: SearchLedger | None) -> dict:
    strategy = decide_resampling(df, cfg)
    folds = stratified_folds(df, cfg.response, cfg.id_col, cfg.outer_folds, seed, out="__outer").checkpoint()
    folds = right_size(folds, folds.count()).persist(StorageLevel.MEMORY_AND_DISK)
    oof_parts, chosen = [], []
    for o in range(cfg.outer_folds):
        if ledger and (known := ledger.predictions(seed, o)) is not None:
            chosen.append((o, ledger.choice(seed, o)))
            oof_parts.append(known)
            continue
        train = folds.where(F.col("__outer") != o).drop("__outer")
        val = folds.where(F.col("__outer") == o).drop("__outer")
        best = grid_search(train, features, cfg, strategy, seed, ledger, o)["best"]
        chosen.append((o, best))
        pipe = refit(train, features, best, cfg, strategy, seed)
        pred = pipe.predict(val).select(cfg.id_col, F.col(cfg.response).alias("label"),
                                        F.col("prediction").cast("int").alias("prediction"), "p1",
                                        F.lit(o).alias("fold"))
        oof_parts.append(ledger.record_outer(seed, o, pred, best, strategy, pipe.features, pipe.prep.removed) if ledger else pred.checkpoint())
    folds.unpersist()
    oof = oof_parts[0]
    for p in oof_parts[1:]:
        oof = oof.unionByName(p)
    fold_metrics = M.binary_summary(oof, "label", "prediction", "p1", ["fold"])
    return {"strategy": strategy, "oof": oof, "fold_metrics": fold_metrics, "chosen": chosen}


def seed_summary(result: dict, seed: int, n_features: int) -> DataFrame:
    """M8: cv_mcc = mean of per-fold MCC (with population std), cv_f1 / cv_auc pooled
    over the out-of-fold predictions."""
    fm = result["fold_metrics"]
    ms = A.mean_std(fm, ["mcc"])
    pooled = M.binary_summary(result["oof"], "label", "prediction", "p1")
    return (ms.crossJoin(pooled.select(F.col("f1_weighted").alias("cv_f1"), F.col("auc").alias("cv_auc")))
            .select(F.lit(seed).alias("seed"), F.col("mcc_mean").alias("cv_mcc"),
                    F.col("mcc_std").alias("cv_mcc_std"), "cv_f1", "cv_auc",
                    F.lit(n_features).alias("n_features")))


def seed_report(result: dict, seed: int, cfg: SearchConfig, pipe: TrainedPipeline, dropped: list[str]) -> DataFrame:
    """The whole row of a seed: summary, pooled confusion, resampling, chosen parameters, features kept and left out."""
    cell = {f"{name}": F.count_if((F.col("label") == a) & (F.col("prediction") == b)) for name, a, b in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))}
    confusion = result["oof"].agg(*(c.alias(k) for k, c in cell.items()))
    texts = lambda xs: F.array(*map(F.lit, xs)).cast("array<string>")
    return (seed_summary(result, seed, len(pipe.features)).crossJoin(confusion)          # one row each
            .select("*", F.lit(MD.canonical(cfg.algorithm)).alias("algorithm"), F.lit(cfg.selection).alias("selection"), F.lit(result["strategy"]).alias("resampling"),
                    F.lit(as_json(pipe.params)).alias("params"), texts(pipe.features).alias("features"),
                    texts(pipe.prep.removed).alias("removed_outliers"), texts(dropped).alias("dropped_constant")))
