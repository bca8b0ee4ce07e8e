"""Apply a trained pipeline to sample files as they land (Structured Streaming).

Preparation statistics are those of a ``reference`` frame (usually the training rows),
frozen when the stream starts, so a sample's score does not depend on the files it
happens to arrive with.  A batch label the reference does not hold is not centred.
Output rows are appended to a parquet sink together with the batch id; the
checkpoint location makes the query restartable (exactly-once per batch id: a
replayed batch overwrites its own partition).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def score_stream(spark: SparkSession, pipe, reference: DataFrame, source_dir: str, schema: T.StructType, sink_dir: str,
                 checkpoint_dir: str, available_now: bool = True, max_files_per_trigger: int | None = None
                 ) -> StreamingQuery:
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    id_col = pipe.id_col
    frozen = pipe.prep.frozen(reference)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        keep = [c for c in (id_col, pipe.response) if c in batch.columns]
        scored = pipe.score(frozen.transform(batch)).select(*keep, F.col("prediction").cast("int").alias("prediction"), "p1")
        (scored.withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))

    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
