"""End-to-end training, persistence and independent-set evaluation.

``train_cohort``  validate -> prepare names -> drop constant columns -> per seed:
                  nested CV (G4-G6) + summary (M8), grid search on all rows and
                  refit (G3, G7), model save (S6); results table (S5).
``evaluate_independent``  M9 on a new sample table with a trained pipeline.
"""

from __future__ import annotations

import json
from dataclasses import asdict

import numpy as np
from pyspark.ml.classification import (DecisionTreeClassificationModel, GBTClassificationModel,
                                       LinearSVCModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.operators import columns as C
from cohort_engine.operators import metrics as M
from cohort_engine.operators import prep as P
from cohort_engine.plans import models as MD
from cohort_engine.plans.ledger import WHOLE, SearchLedger
from cohort_engine.plans.pipeline_prep import PreparedModel, cohort_features
from cohort_engine.sources.tables import nan_to_null
from cohort_engine.plans.tuning import (SearchConfig, TrainedPipeline, decide_resampling, grid_search,
                                        nested_cv, refit, seed_report)
from cohort_engine.sources.validate import SampleSchema, validate

_MODEL_CLASSES = {
    "logistic_regression": LogisticRegressionModel, "svm": LinearSVCModel, "xgboost": GBTClassificationModel,
    "random_forest": RandomForestClassificationModel, "cart": DecisionTreeClassificationModel,
}


def train_cohort(df: DataFrame, cfg: SearchConfig, seeds=(42,), output: str | None = None,
                 run_nested: bool = True) -> dict:
    """Train as the reference's pipeline does; returns per-seed results and pipelines.

    With ``output``, every finished split is kept in a ledger there: a run that was killed
    fits what is missing when it is started again."""
    df = nan_to_null(validate(df, SampleSchema(response=cfg.response.lower(), batch_col=cfg.batch_col or "batch")))
    feats = cohort_features(df, cfg.response, cfg.batch_col or "batch")
    enc = C.encode_sex(df)
    _, kept, dropped = C.drop_constant(enc, feats)          # judged on the full set (Q14)
    keys = [c for c in (cfg.id_col, cfg.response, cfg.batch_col) if c and c in df.columns]
    cohort = enc.select(*keys, *kept)
    summaries, pipelines, nested, tables = [], {}, {}, {}
    ledger = SearchLedger(df.sparkSession, f"{output}/ledger/{MD.canonical(cfg.algorithm)}_{cfg.selection}") if output else None
    for seed in seeds:
        if run_nested:
            res = nested_cv(cohort, kept, cfg, seed, ledger)
            nested[seed] = res
        strategy = decide_resampling(cohort, cfg)
        search = grid_search(cohort, kept, cfg, strategy, seed, ledger)
        best, tables[seed] = search["best"], search["table"]
        pipe = refit(cohort, kept, best, cfg, strategy, seed)
        pipelines[seed] = pipe
        if run_nested:
            summaries.append(seed_report(nested[seed], seed, cfg, pipe, dropped))
        if ledger:
            ledger.record_choice(seed, WHOLE, best, strategy, pipe.features, pipe.prep.removed)
        if output:
            save_pipeline(pipe, f"{output}/{MD.canonical(cfg.algorithm)}_{cfg.selection}/seed={seed}",
                          df.sparkSession)
    table = None
    for s in summaries:
        table = s if table is None else table.unionByName(s)
    if output and table is not None:
        write_results(table, f"{output}/all_seeds_results")
    return {"dropped_constant": dropped, "pipelines": pipelines, "nested": nested, "summary": table, "tables": tables, "ledger": ledger}


def write_results(table: DataFrame, path: str) -> None:
    """The per-seed summary table as parquet and a header CSV."""
    table.write.mode("overwrite").parquet(path + ".parquet")
    flat = [F.array_join(c, ";").alias(c) if kind.startswith("array") else F.col(c) for c, kind in table.dtypes]       # a CSV cell holds no list
    table.select(*flat).coalesce(1).write.mode("overwrite").option("header", True).csv(path + ".csv")


# ---------------------------------------------------------------------------
# persistence
# ---------------------------------------------------------------------------

def _write_json(spark: SparkSession, obj: dict, path: str) -> None:
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("".join(r.value for r in spark.read.text(path).collect()))


def save_pipeline(pipe: TrainedPipeline, path: str, spark: SparkSession) -> None:
    prep = {
        "features": pipe.prep.features, "removed": pipe.prep.removed,
        "normalizer": asdict(pipe.prep.normalizer),
        "scaler": {"cols": pipe.prep.scaler.cols, "means": pipe.prep.scaler.means, "scales": pipe.prep.scaler.scales},
        "imputer": {"cols": pipe.prep.imputer.cols, "medians": pipe.prep.imputer.medians},
    }
    meta = {"algorithm": pipe.model.algorithm, "params": pipe.params, "features": pipe.features,
            "response": pipe.response, "id_col": pipe.id_col, "prep": prep, "calibrated": pipe.model.platt is not None,
            "rff": None if pipe.model.rff is None else [pipe.model.rff[0].tolist(), pipe.model.rff[1].tolist()]}
    _write_json(spark, meta, f"{path}/meta")
    pipe.model.model.write().overwrite().save(f"{path}/model")
    if pipe.model.platt is not None:
        pipe.model.platt.write().overwrite().save(f"{path}/platt")


def load_pipeline(spark: SparkSession, path: str) -> TrainedPipeline:
    meta = _read_json(spark, f"{path}/meta")
    pr = meta["prep"]
    norm = P.NormalizerModel(**pr["normalizer"])
    prep = PreparedModel(pr["features"], norm, P.ScalerModel(**pr["scaler"]), P.ImputerModel(**pr["imputer"]),
                         pr["removed"])
    algo = meta["algorithm"]
    model = _MODEL_CLASSES[algo].load(f"{path}/model")
    platt = LogisticRegressionModel.load(f"{path}/platt") if meta.get("calibrated") else None
    rff = None if meta["rff"] is None else (np.array(meta["rff"][0]), np.array(meta["rff"][1]))
    fitted = MD.FittedModel(algo, meta["params"], model, platt, rff)
    return TrainedPipeline(prep, meta["features"], fitted, meta["params"], meta["response"], meta["id_col"])


def pick_model_path(spark: SparkSession, root: str, seed: int | None = None) -> str:
    """The model of ``seed``, else the lowest seed found; error when none."""
    if seed is not None:
        return f"{root}/seed={seed}"
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            name = st.getPath().getName()
            if name.startswith("seed=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "meta")):
                found.append(int(name.split("=", 1)[1]))
    if not found:
        raise FileNotFoundError(f"no saved model under {root}")
    return f"{root}/seed={min(found)}"


# ---------------------------------------------------------------------------
# M9
# ---------------------------------------------------------------------------

def evaluate_independent(pipe: TrainedPipeline, df: DataFrame, response: str | None = None) -> dict:
    """Score an independent table: lower-case names, drop ids from the features,
    align to the training columns (absent -> 0.0), predict, and compute metrics.

    Returns ``{'metrics': 1-row DataFrame(mcc, f1_weighted, accuracy, auc, aupr, n),
    'confusion': DataFrame(actual, predicted, n), 'predictions': DataFrame}``.
    """
    response = (response or pipe.response).lower()
    df = C.lower_names(df)
    _, response = C.split_xy(C.encode_sex(df), response)
    batch = pipe.prep.normalizer.batch_col
    keys = [c for c in (pipe.id_col, "patient", response, batch) if c and c in df.columns]
    aligned = C.align_columns(C.encode_sex(df), pipe.prep.features, keep=keys)
    pred = pipe.predict(aligned).select(*[c for c in keys if c != response],
                                        F.col(response).alias("label"),
                                        F.col("prediction").cast("int").alias("prediction"), "p1")
    pred = pred.checkpoint()               # read by three results; Spark cleans it up with the frame
    metrics = M.binary_summary(pred, "label", "prediction", "p1").crossJoin(
        pred.agg(F.count(F.lit(1)).alias("n")))
    return {"metrics": metrics, "confusion": M.confusion(pred, "label", "prediction"), "predictions": pred}
