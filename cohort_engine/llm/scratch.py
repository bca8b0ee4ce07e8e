"""Tables of one run in the folder that the cluster shares.

A written table cuts lineage as a checkpoint does, but it is compressed, read by columns,
and can be deleted as soon as its last reader is done.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohort_engine.session import ensure_checkpoint_dir


class Scratch:
    """A fresh folder below ``spark.checkpoint.dir`` for the tables of one run."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as table ``name`` and read again."""
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.get(df, name)

    def get(self, like: DataFrame, name: str) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables nothing reads any more (a missing one is no error)."""
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
