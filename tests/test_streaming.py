"""A trained pipeline scores sample files through Structured Streaming."""

from pyspark.sql import functions as F

from cohort_engine.plans.tuning import SearchConfig, refit
from cohort_engine.sources import fixtures as FX
from cohort_engine.streaming.scoring import score_stream

from conftest import SF_SMALL


def test_stream_scores_every_row(spark, tmp_path):
    df = FX.c5_signal(spark, SF_SMALL)
    feats = ["age", "totalprice", "qty", "price", "disc", "tax"]
    pipe = refit(df, feats, {"C": 1, "penalty": "l2", "k": 4}, SearchConfig(algorithm="logistic_regression"),
                 "oversampling", 42)
    src = str(tmp_path / "incoming")
    df.repartition(3).write.parquet(src)
    q = score_stream(spark, pipe, df, src, df.schema, str(tmp_path / "scored"), str(tmp_path / "ckpt"),
                     max_files_per_trigger=1)
    q.awaitTermination(300)
    out = spark.read.parquet(str(tmp_path / "scored"))
    assert out.count() == df.count()
    assert out.select("batch_id").distinct().count() >= 1
    assert out.where("p1 < 0 or p1 > 1").count() == 0
    whole = pipe.score(pipe.prep.frozen(df).transform(df)).select("patient_id", F.col("p1").alias("at_once"))
    assert out.join(whole, "patient_id").where("abs(p1 - at_once) > 1e-12").count() == 0
