"""Cutting lineage through a written table in shared storage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Lets Spark remove what an execution shuffled when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
_scopes = threading.local()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: what the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, because a folder on one
    machine is invisible to executors on others.
    """
    conf = spark.sparkContext.getConf()
    named = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="seqloom-")
    return _local_roots[app]


def scratch_path(spark: SparkSession) -> str:
    """A new folder name under the scratch root of this application."""
    return f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once and read it back.

    The copy is columnar, so later readers prune columns, and its size is known, so joins on it
    are planned from real statistics. It outlives lost executors. What the write shuffled is read by
    nothing else and leaves the disks with it, so a job of many cuts holds the shuffles of one at a time.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    for made in getattr(_scopes, "open", []):
        made.append(path)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_cuts(spark: SparkSession, made: list[str], but: int = 0) -> None:
    """Remove the tables below the folders ``made``, except the last ``but``, which stay in it."""
    gone = made[: len(made) - but]
    del made[: len(gone)]
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(conf).delete(place, True)


@contextmanager
def cuts_dropped(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables that :func:`cut_lineage` writes inside this block when it ends, well or not.

    For jobs that go on: what a batch cut is of no use once the batch is written. The block gets the folders,
    in order; a table whose folder it takes out of them stays, until a block around it ends.
    """
    made: list[str] = []
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append(made)
    try:
        yield made
    finally:
        scopes[:] = [s for s in scopes if s is not made]
        drop_cuts(spark, made)
