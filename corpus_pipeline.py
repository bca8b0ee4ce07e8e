"""The corpus pipeline: documents scored, filtered, deduplicated, decontaminated and packed.

Each stage takes ``(spark, docs, sf_dir)`` and returns the documents it keeps (all
columns), the last one the packed pieces.  ``run`` writes every stage's result to the
shared checkpoint folder and reads it again as the next one's documents, so a lost
executor costs at most a stage's own work.

Stages decide on rows, known by a 128-bit key of id and text: a rejected text takes no
other text of its id along, and a row without id is judged like any other.  Near-dedup
gives rows without id a stand-in above all ids and keeps one of equal rows.  Columns of
``documents`` other than ``doc_id`` and ``text`` pass through untouched, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort_engine.llm.common import prepare, table
from cohort_engine.llm.decontaminate import contamination
from cohort_engine.llm.near_duplicates import near_duplicates
from cohort_engine.llm.packing import pack_documents
from cohort_engine.llm.quality import score_quality
from cohort_engine.llm.toxicity import score_toxicity
from cohort_engine.session import ensure_checkpoint_dir

#: DuckDB cannot express training, so the pipeline is tested stage by stage against brute force.
ORACLE_SQL = None


KEYS = ["_row_a", "_row_b"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` as (doc_id, text) with two independent 64-bit hashes of both."""
    return docs.select("doc_id", "text", *(F.xxhash64(F.lit(k), F.col("doc_id").cast("string"), F.col("text")).alias(c) for k, c in enumerate(KEYS)))


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """``docs`` but for the rows with rejected keys.

    The rejected keys are cut off from their lineage first; Spark broadcasts them where it
    measures them to be small and shuffles otherwise."""
    gone = rejected.select(*KEYS).distinct().checkpoint()
    rows = docs.select(*(F.xxhash64(F.lit(k), F.col("doc_id").cast("string"), F.col("text")).alias(c) for k, c in enumerate(KEYS)), F.struct(*docs.columns).alias("_row"))
    return rows.join(gone, KEYS, "left_anti").select("_row.*")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without(docs, score_toxicity(keyed(docs), table(spark, sf_dir, "labels"), carry=KEYS).where("predicted = 1"))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without(docs, score_quality(keyed(docs), table(spark, sf_dir, "labels"), carry=KEYS).where("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: of the smallest id, and of equal rows the first."""
    prepare(spark)
    rows = keyed(docs)
    stand_in = F.shiftrightunsigned(F.xxhash64("text"), 2) + F.lit(1 << 62)
    found = near_duplicates(rows.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), stand_in)), carry=KEYS).checkpoint()
    left = without(docs, found.where("NOT kept"))
    # what is still there several times: equal rows, and texts without words that repeat an id
    repeated = found.where("kept").groupBy(*KEYS).agg(F.count("*").alias("n")).where("n > 1").select(*KEYS).checkpoint()
    if repeated.isEmpty():
        return left
    both = left.withColumn("_row", F.struct(*left.columns)).select("_row", *(F.xxhash64(F.lit(k), F.col("_row.doc_id").cast("string"), F.col("_row.text")).alias(c) for k, c in enumerate(KEYS)))
    once = both.join(repeated, KEYS, "left_semi").groupBy(*KEYS).agg(F.first("_row").alias("_row"))
    return both.join(repeated, KEYS, "left_anti").select("_row.*").unionByName(once.select("_row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return without(docs, contamination(keyed(docs), table(spark, sf_dir, "benchmark"), carry=KEYS).where("contaminated"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pack_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_poor),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
