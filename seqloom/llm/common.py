"""What the operators of this package share: table access, scratch tables, batches for Python."""

from __future__ import annotations

import logging
import os
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.operators.lineage import scratch_path
from seqloom.session import ship_package

# Rows that go to a Python worker at a time; bounds a worker's memory whatever a partition holds.
BATCH_ROWS = 512

log = logging.getLogger(__name__)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def settled(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with computed columns that later steps read and never work out again.

    Columns of a generator are not replaced by their expressions, which Spark would otherwise copy
    into every filter and lambda function that names them.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def ready_for_python(spark: SparkSession) -> None:
    """Ship this package to the workers and bound the batches they get."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that this application wrote and has finished with."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables written below ``spark.checkpoint.dir`` in the course of one operator."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def path(self) -> str:
        made = scratch_path(self.spark)
        self.paths.append(made)
        return made

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back: the copy outlives lost executors and has a known size."""
        to = self.path()
        df.write.parquet(to)
        return self.spark.read.schema(df.schema).parquet(to)

    def drop(self, *frames: DataFrame) -> None:
        """Remove the tables behind frames that nothing reads any more."""
        gone = {os.path.dirname(f) for frame in frames for f in frame.inputFiles()}
        for path in [p for p in self.paths if any(g.endswith(p.split(":", 1)[-1].rstrip("/")) for g in gone)]:
            drop_path(self.spark, path)
            self.paths.remove(path)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A runtime setting that holds while the jobs inside run."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


@contextmanager
def pruned_by_bloom(spark: SparkSession) -> Iterator[None]:
    """Let Spark prune the large side of a selective join with a Bloom filter of the other side's
    keys before it is dealt out, at every size of input. Holds for joins on one key whose other side
    is a filtered table. The size of the filter is bounded by the session's ``maxNumBits``.
    """
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    with setting(spark, f"{prefix}.applicationSideScanSizeThreshold", "0"), setting(spark, f"{prefix}.creationSideThreshold", "1g"):
        yield
