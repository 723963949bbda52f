"""Incremental forms of the batch jobs on Structured Streaming file sources."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import best_per_key


def new_files(spark: SparkSession, path: str, schema: str, file_format: str = "parquet", files_per_batch: int = 1000, **options) -> DataFrame:
    """Files that appeared since the last run (the checkpoint remembers them)."""
    reader = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> None:
    """Process what is there and stop; a rerun with nothing new does nothing."""
    query = (
        stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(each).start()
    )
    query.awaitTermination()


def append_partitions(path: str, partition: str, shape: Callable[[DataFrame], DataFrame], batch_column: str = "batch_id"):
    """foreachBatch writer that adds each batch once.

    The batch's number is a second partition column, and only the batch's own folders are replaced: a retry
    of a batch is harmless, and what other batches wrote to the same partition stays."""

    def write(batch: DataFrame, epoch: int) -> None:
        rows = shape(batch).withColumn(batch_column, F.lit(epoch))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition, batch_column).parquet(path)

    return write


def supersede(path: str, keys: list[str], rank: list[Column], partition: str):
    """foreachBatch writer that keeps the best version per key (a final beats a draft).

    Only partitions that the batch touches are read again and rewritten.  The new
    content is materialised to the checkpoint folder before its source is replaced.
    """
    from ..session import cut_lineage

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        touched = batch.select(partition).distinct()
        rows = batch
        try:
            stored = spark.read.parquet(path).select(*batch.columns)
            rows = rows.unionByName(stored.join(touched, partition, "left_semi"))
        except Exception as error:  # first batch: nothing stored yet
            if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
                raise
        best = cut_lineage(best_per_key(rows, keys, rank))
        best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)

    return write


def activity_sessions(stream: DataFrame, key: str, time: str, gap: str = "60 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions split where a key is silent for longer than the gap; late rows up to the watermark."""
    return (
        stream.withWatermark(time, late)
        .groupBy(F.session_window(F.col(time), gap).alias("w"), F.col(key))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"))
        .select(key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "rows", "first_ts", "last_ts")
    )
