"""Token totals by source, language and tokenizer version, kept by signed deltas.

A batch of changes (inserted, revised and deleted documents) is turned into deltas: what a document
counted for before goes out with a negative sign, what it counts for now comes in. Per batch the
store has the entries of the changed documents and the summed deltas, in folders named by the batch;
a marker written last commits it. Readers see committed batches only. A batch that is applied again
is left alone if it was committed and written anew if it was not, so retries change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, ready_for_python
from seqloom.llm.tokens import tokens

VERSION = "byte_bpe_50k"
ENTRY = "doc_id bigint, part string, source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint, live boolean"
KEY = ["doc_id", "part", "tokenizer"]
DELTA = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"


def count_tokens(docs: DataFrame, keep: list[str], folder: str | None = None) -> DataFrame:
    """The columns ``keep`` with ``n_tokens`` of the whole text; a null text has none."""
    ready_for_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(folder).encode
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())], names=[*batch.schema.names[1:], "n_tokens"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(F.col("text").alias("_text"), *keep).mapInArrow(run, f"{fields}, n_tokens bigint")


class Rollup:
    """Totals in a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, *parts: object):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *map(str, parts)]))

    def _system(self):
        return self._path("commits").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def committed(self) -> list[int]:
        """Numbers of the batches that count, in order."""
        system, place = self._system(), self._path("commits")
        if not system.exists(place):
            return []
        return sorted(int(s.getPath().getName()) for s in system.listStatus(place))

    def _read(self, what: str, schema: str) -> DataFrame:
        paths = [f"{self.folder}/{what}/{n}" for n in self.committed()]
        if not paths:
            return self.spark.createDataFrame([], schema + ", batch int")
        parts = F.regexp_extract(F.col("_metadata.file_path"), rf"/{what}/([0-9]+)/", 1).cast("int")
        return self.spark.read.schema(schema).parquet(*paths).select("*", parts.alias("batch"))

    def entries(self) -> DataFrame:
        """The last entry of each document and tokenizer, deleted ones included."""
        last = F.max_by(F.struct("source", "lang", "n_docs", "n_tokens", "live"), "batch").alias("e")
        return self._read("entries", ENTRY).groupBy(*KEY).agg(last).select(*KEY, "e.*")

    def totals(self) -> DataFrame:
        """Documents and tokens by source, language and tokenizer version."""
        summed = self._read("deltas", DELTA).groupBy("source", "lang", "tokenizer")
        return summed.agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).filter("n_docs <> 0 OR n_tokens <> 0")

    def apply(self, number: int, changes: DataFrame) -> bool:
        """Apply a batch of (doc_id, source, lang, tokenizer, n_tokens, live); false if it was before.

        Optional columns: ``part`` tells apart rows that share an id or have none (nothing by default), and
        ``n_docs`` is the number of equal rows a change stands for (1), whose tokens ``n_tokens`` sums. An
        entry is one id, part and tokenizer, nulls included. ``live`` false deletes: only its id, part and
        tokenizer count then, and one that is not held changes nothing. Of several changes of one entry in a
        batch a deletion counts if there is one, then the one with the most tokens, source and language.
        Null sources, languages and tokenizers are keys like others.
        """
        if number in self.committed():
            return False
        values = ["source", "lang", "n_docs", "n_tokens", "live"]
        given = lambda name, other, kind: F.coalesce(F.col(name) if name in changes.columns else F.lit(None), F.lit(other)).cast(kind)
        usable = changes.withColumns({"part": given("part", "", "string"), "n_docs": given("n_docs", 1, "long"), "live": given("live", True, "boolean")})
        order = F.struct((~F.col("live")).alias("gone"), F.coalesce("n_tokens", F.lit(0)).cast("long").alias("n_tokens"), "source", "lang", "n_docs", "live")
        one = usable.groupBy(*KEY).agg(F.max(order).alias("c")).select(*KEY, *[f"c.{v}" for v in values])
        names = [part.split(" ")[0] for part in ENTRY.split(", ")]
        one.select(*names).write.mode("overwrite").parquet(f"{self.folder}/entries/{number}")
        now = self.spark.read.schema(ENTRY).parquet(f"{self.folder}/entries/{number}")
        touched = now.select(*[F.col(k).alias(f"_{k}") for k in KEY])
        before = self.entries().filter("live").join(touched, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in KEY], "left_semi")
        told = ["source", "lang", "tokenizer", "n_docs", "n_tokens"]
        signed = now.filter("live").select(*told, F.lit(1).alias("sign")).unionByName(before.select(*told, F.lit(-1).alias("sign")))
        deltas = signed.groupBy("source", "lang", "tokenizer").agg(
            *[F.sum(F.col("sign") * F.col(c)).cast("long").alias(c) for c in ("n_docs", "n_tokens")]
        )
        deltas.write.mode("overwrite").parquet(f"{self.folder}/deltas/{number}")
        self._system().create(self._path("commits", number), True).close()
        return True


def corpus_rollup(docs: DataFrame, version: str = VERSION, folder: str | None = None) -> DataFrame:
    """Totals of ``docs`` after three batches: all rows in, equal texts out but for those of the largest
    id, and texts with a licence line revised to be without it. The second batch is sent twice.

    Every row counts: rows are told apart by id and by a digest of text, source and language, and rows
    equal in all of these are one entry that counts them all. Of equal texts a row without an id goes if
    another has one. A null text has no tokens and equals the empty one. An empty table gives no totals.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    rollup = Rollup(spark, scratch.path())
    text = F.coalesce("text", F.lit(""))
    # nulls and field borders are told apart in the digest
    named = F.sha2(F.to_json(F.struct("text", "source", "lang")), 256)
    kept = ["doc_id", "source", "lang", "part"]
    rows = docs.select("doc_id", "source", "lang", "text", named.alias("part"), F.sha2(text, 256).alias("digest"))
    told = [F.lit(version).alias("tokenizer"), F.lit(True).alias("live")]

    def summed(counted: DataFrame) -> DataFrame:
        entries = counted.groupBy(*kept).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return entries.select("*", *told)

    rollup.apply(0, summed(count_tokens(rows, kept, folder)))
    digests = rows.select("doc_id", "part", "digest")
    largest = digests.groupBy("digest").agg(F.max("doc_id").alias("stays"))
    gone = digests.join(largest, "digest").filter("stays IS NOT NULL AND NOT doc_id <=> stays").select("doc_id", "part")
    none = F.lit(None).cast("string")
    deleted = gone.select("doc_id", "part", none.alias("source"), none.alias("lang"), F.lit(0).cast("long").alias("n_tokens"), F.lit(version).alias("tokenizer"), F.lit(False).alias("live"))
    for _ in range(2):
        rollup.apply(1, deleted)
    shorter = F.regexp_replace("text", r"(?m)^.*(?i:licensed under|released under).*$\n?", "")
    out = gone.select(F.col("doc_id").alias("_id"), F.col("part").alias("_part"))
    revised = rows.withColumn("_shorter", shorter).filter("_shorter <> text")
    revised = revised.join(out, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("part") == F.col("_part")), "left_anti")
    rollup.apply(2, summed(count_tokens(revised.drop("text").withColumnRenamed("_shorter", "text"), kept, folder)))
    return rollup.totals()
