"""Exact deduplication as a stateful stream.

A stream of arrivals is folded into keyed state on disk (RocksDB), one entry per content digest,
never expired. An entry retains the stable identifier of the row that stays, the locator of its
content (file and row in it) and how many rows arrived. A later row with a digest that is already
held is a hit, and hits are settled by the full bytes: their text is compared with the text at the
retained locator. Digests of which some hit differs are split by the text itself.

Everything is DataFrame operations; the state lives in Spark's state store and its checkpoint below
``spark.checkpoint.dir``, so a lost executor or a restarted query resumes from the last batch.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, drop_path, pruned_by_bloom, setting, whole_text

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Files of arrivals a micro-batch takes; more batches mean less rework after a failure.
FILES_PER_BATCH = 64


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def fold_arrivals(stream: DataFrame) -> DataFrame:
    """State of a stream of (digest, id, file, row): what is held for each digest, without expiry.

    The row that stays is the one with the largest id, then the largest locator; rows without an id
    stay only if no row of the digest has one.
    """
    return stream.groupBy("digest").agg(
        F.max(F.struct("id", "file", "row")).alias("held"), F.count(F.lit(1)).alias("n")
    )


def run_state(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Fold a stream until its input is used up; every batch writes the entries it changed.

    A batch writes into a folder named by its number and overwrites it when it is repeated, so a
    retry after a failure leaves the same table.
    """

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        fold_arrivals(stream)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(f"dedup-{uuid.uuid4().hex[:8]}")
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()


def arrivals(docs: DataFrame, digest=sha256, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """Identifier, digest and content locator of every row of a table of files."""
    return docs.select(
        F.col(id_col).alias("id"),
        digest(whole_text(text_col)).alias("digest"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
        *more,
    )


def exact_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, digest, file, row.

    Null texts equal empty ones. Of equal texts the row with the largest id stays, of rows that
    agree in both the one with the largest locator, so exactly one row of every group has ``kept``;
    rows without an id stay only where no row of the group has one (``keep_id`` is null then). An
    empty table gives an empty result. Columns other than the two named are not read.

    ``docs`` that is not read straight from files is written to the scratch folder first, so that
    its rows have locators.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    try:
        fed = arrivals(docs, digest, id_col, text_col)
    except AnalysisException:
        slim = scratch.cut(slim)
        fed = arrivals(slim, digest, "id", "text")
        docs, id_col, text_col = slim, "id", "text"
    log = scratch.path()
    fed.write.parquet(log)
    stream = spark.readStream.schema(fed.schema).option("maxFilesPerTrigger", files_per_batch).parquet(log)
    changes, checkpoint = scratch.path(), scratch.path()
    with (
        setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKSDB),
        setting(spark, "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"),
        setting(spark, "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage", "true"),
        # many small stores: no disk is set aside for their logs in advance
        setting(spark, "spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false"),
    ):
        run_state(stream, changes, checkpoint)
    rows = spark.read.schema(fed.schema).parquet(log)
    entry = "digest string, held struct<id: %s, file: string, row: bigint>, n bigint" % fed.schema["id"].dataType.simpleString()
    state = scratch.cut(latest_state(spark, changes, entry))
    for used in (changes, checkpoint):  # the stream has ended and its last entries are written
        drop_path(spark, used)
    return settle(scratch, docs, rows, state, digest, id_col, text_col)


def latest_state(spark: SparkSession, changes: str, schema: str) -> DataFrame:
    """The last entry of each digest; counts only grow, so it is the one with the largest."""
    found = spark.read.schema(schema + ", batch int").parquet(changes)
    return found.groupBy("digest").agg(F.max(F.struct("n", "held")).alias("s")).select("digest", "s.n", "s.held")


def settle(scratch: Scratch, docs: DataFrame, rows: DataFrame, state: DataFrame, digest, id_col: str, text_col: str) -> DataFrame:
    """Check hits by their full bytes, and split the digests that stand for several texts."""
    is_held = (F.col("file") == F.col("held.file")) & (F.col("row") == F.col("held.row"))
    located = arrivals(docs, digest, id_col, text_col, whole_text(text_col).alias("text"))
    multiple = scratch.cut(state.filter("n > 1"))
    with pruned_by_bloom(docs.sparkSession):
        texts = located.join(multiple.filter("n > 1"), "digest")
        texts = scratch.cut(texts.withColumn("is_held", is_held))
    held = texts.filter("is_held").select("digest", F.col("text").alias("held_text"))
    hits = texts.filter(~F.col("is_held"))
    differ = hits.join(held, "digest").filter(F.col("text") != F.col("held_text")).select("digest").distinct()
    differ = scratch.cut(differ)
    sound = rows.join(state, "digest").select(
        "id", F.col("held.id").alias("keep_id"), F.col("n").alias("group_size"), is_held.alias("kept"), "digest", "file", "row"
    )
    if differ.isEmpty():
        scratch.drop(texts, multiple)
        return sound
    apart = texts.join(differ, "digest", "left_semi")
    by_text = apart.groupBy("digest", "text").agg(
        F.max(F.struct("id", "file", "row")).alias("own"), F.count(F.lit(1)).alias("group_size")
    )
    own = (F.col("file") == F.col("own.file")) & (F.col("row") == F.col("own.row"))
    split = apart.join(by_text, ["digest", "text"]).select(
        "id", F.col("own.id").alias("keep_id"), "group_size", own.alias("kept"), "digest", "file", "row"
    )
    return sound.join(differ, "digest", "left_anti").select(*sound.columns).unionByName(split)


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of a table of files that stay, with all their columns."""
    judged = exact_dedup(docs, id_col, text_col)
    gone = judged.filter(~F.col("kept")).select(F.col("file").alias("_file"), F.col("row").alias("_row"))
    placed = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return placed.join(gone, ["_file", "_row"], "left_anti").select(*docs.columns)
