"""Running a stream over what is available and reading its result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seqloom.operators.lineage import scratch_path
from seqloom.operators.ordering import keep_first


def drain(stream: DataFrame, mode: str = "append", keys: Sequence[str] | None = None, path: str | None = None,
          checkpoint: str | None = None) -> DataFrame:
    """Run ``stream`` until its input is used up, into one table partition per micro-batch.

    With ``keys`` (update mode) the newest row per key is the result. Rerunning with the same
    ``path`` and ``checkpoint`` continues where the last run stopped.
    """
    spark = stream.sparkSession
    table = path or scratch_path(spark)

    def write(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        tagged.write.mode("overwrite").partitionBy("batch_id").option("partitionOverwriteMode", "dynamic").parquet(table)

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint or scratch_path(spark))
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return newest(spark, table, stream, keys)


def newest(spark: SparkSession, table: str, stream: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_id", T.LongType())])
    rows = spark.read.schema(schema).parquet(table)
    if keys:
        rows = keep_first(rows, keys, [F.desc("batch_id")])
    return rows.drop("batch_id")


def stream_table(df: DataFrame, files_per_trigger: int | None = None) -> DataFrame:
    """``df`` as a stream over a written copy of it."""
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    reader = spark.readStream.schema(df.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
