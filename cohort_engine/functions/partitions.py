"""Partition sizing for frames that many jobs re-read (model inputs, fold tables)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

ROWS_PER_PARTITION_CONF = "cohort.rowsPerPartition"
# a tree fit keeps some 500 bytes a row, which a task reads again in every round
DEFAULT_ROWS_PER_PARTITION = 200_000
# never split below this many rows per partition just to occupy idle cores
MIN_ROWS_PER_PARTITION = 50_000


ROWS_PER_BUCKET = 500_000


def bucket_count(spark: SparkSession, n_rows: int) -> int:
    """Buckets of an ordered pass: one a shuffle partition, more where those would grow too long."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), math.ceil(n_rows / ROWS_PER_BUCKET))


def target_partitions(df: DataFrame, n_rows: int) -> int:
    """``ceil(rows / rows_per_partition)``, raised to the core count while each
    partition still keeps ``MIN_ROWS_PER_PARTITION`` rows."""
    rpp = int(df.sparkSession.conf.get(ROWS_PER_PARTITION_CONF, str(DEFAULT_ROWS_PER_PARTITION)))
    by_size = math.ceil(n_rows / max(1, rpp))
    cores = df.sparkSession.sparkContext.defaultParallelism
    by_cores = min(cores, math.ceil(n_rows / MIN_ROWS_PER_PARTITION))
    return max(1, by_size, by_cores)


def right_size(df: DataFrame, n_rows: int) -> DataFrame:
    """Coalesce to :func:`target_partitions` partitions (never more than now).

    Iterative fits run one job per iteration over every partition, so a frame of a
    few thousand rows spread over hundreds of partitions spends its time
    scheduling.  Call it on a persisted parent: ``coalesce`` is narrow and would
    otherwise reduce the parallelism of the stage that computes the rows.
    """
    return df.coalesce(target_partitions(df, n_rows))


def stored(df: DataFrame) -> DataFrame:
    """``df`` kept and counted, so that a join planned with it knows its bytes before any row of the other side moves."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    df.count()
    return df
