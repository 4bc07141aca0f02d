"""Keyed tables on files: upserts, retention, deletes, audit rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import keep_first

# Days kept per table.
RETENTION_DAYS = {"raw_protein_events": 30, "failed_requests_by_time": 30, "pipeline_metrics_by_window": 90}
HISTORY_TABLES = (
    "request_status_by_id", "requests_by_day", "requests_by_status_window", "requests_by_user_window",
    "requests_by_protein_window", "request_proteins_by_request", "protein_requests_by_protein",
    "request_timeline_by_id", "latest_prediction_by_protein", "prediction_history_by_protein",
    "pipeline_metrics_by_window", "cassandra_serving_stats_by_day",
)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """SNK-07: target with source rows written over it; per key the last row wins, nulls included.

    ``order`` decides among source rows of one key; any source row wins over the target.
    """
    both = target.withColumn("_side", F.lit(0)).unionByName(
        source.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    newest = [F.desc("_side"), *[F.desc(c) for c in order]]
    return keep_first(both, keys, newest).drop("_side")


def upsert_keep(target: DataFrame, source: DataFrame, keys: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """SNK-08: like an upsert of one row per key, but ``keep`` columns of an existing row stay."""
    old_rows, new_rows = target.alias("t"), source.withColumn("_new", F.lit(True)).alias("s")
    joined = old_rows.join(new_rows, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    has_new = F.col("s._new").isNotNull()
    out = []
    for c in target.columns:
        old, new = F.col(f"t.{c}"), F.col(f"s.{c}")
        if c in keys or c in keep:
            out.append(F.coalesce(old, new).alias(c))
        else:
            out.append(F.when(has_new, new).otherwise(old).alias(c))
    return joined.select(*out)


def expire(df: DataFrame, ts: str, days: int, now: datetime) -> DataFrame:
    """SNK-09: rows younger than ``days``; a constant bound that reaches the scan."""
    limit = F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") - F.make_dt_interval(days=F.lit(days))
    return df.filter(F.col(ts) > limit)


def drop_days(spark: SparkSession, path: str, days: int, now: datetime) -> list[str]:
    """SNK-09: drop the ``day=`` folders of a table of :func:`write_by_day` that lie wholly more than
    ``days`` back. Folders go by name; no row is read. Returns their names in order."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    first_kept = f"day={(now - timedelta(days=days)).date().isoformat()}"
    names = sorted(s.getPath().getName() for s in files.listStatus(place) if s.isDirectory())
    gone = [n for n in names if n.startswith("day=") and n[4:].replace("-", "").isdigit() and n < first_kept]
    for name in gone:
        files.delete(jvm.org.apache.hadoop.fs.Path(path, name), True)
    return gone


def delete_request(tables: Mapping[str, DataFrame], requests: DataFrame) -> dict[str, DataFrame]:
    """SNK-10: every table without the given requests (column request_id).

    The latest prediction of a protein goes only if it came from such a request, which is what
    its own request_id column says.
    """
    gone = requests.select("request_id").distinct()
    return {name: df.join(gone, "request_id", "left_anti") for name, df in tables.items()}


def truncate_tables(spark: SparkSession, paths: Mapping[str, str]) -> None:
    """SNK-11: empty the history tables at ``paths``, keeping their schemas."""
    for name in HISTORY_TABLES:
        if name in paths:
            schema = spark.read.parquet(paths[name]).schema
            spark.createDataFrame([], schema).write.mode("overwrite").parquet(paths[name])


def audit_record(df: DataFrame, actor: Column, action: str, target_type: str, target_id: Column, detail: Column) -> DataFrame:
    """SNK-12: audit rows; the id is a hash of the content, so no global counter is needed."""
    rows = df.select(
        actor.alias("actor"),
        F.lit(action).alias("action"),
        F.lit(target_type).alias("target_type"),
        target_id.cast("string").alias("target_id"),
        detail.alias("detail"),
    )
    return rows.withColumn(
        "audit_id", F.sha2(F.concat_ws("|", "actor", "action", "target_type", "target_id", "detail"), 256)
    )


def append_audit(rows: DataFrame, path: str, now: datetime | None = None) -> None:
    """SNK-12: append audit rows with their time."""
    stamp = F.now() if now is None else F.lit(now.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    rows.withColumn("created_at", stamp).write.mode("append").parquet(path)


def write_by_day(df: DataFrame, path: str, ts: str, zone: str = S.APP_ZONE) -> None:
    """Table layout for day-bounded reads: one folder per local day.

    Days are spread over tasks by day and a salt, so one heavy day does not fall to one writer.
    """
    salted = df.withColumn("day", S.local_day(F.col(ts), zone))
    salted.repartition(F.col("day"), F.pmod(F.xxhash64(*df.columns[:1]), F.lit(16))).write.partitionBy("day").option(
        "partitionOverwriteMode", "dynamic"
    ).mode("overwrite").parquet(path)


def apply_upsert(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], order: Sequence[str],
                 partition: str | None = None) -> None:
    """SNK-07 on a stored table. With a ``partition`` column that is part of the key, only the
    partitions the source touches are read and rewritten.
    """
    target = spark.read.parquet(path)
    if partition is not None:
        touched = source.select(partition).distinct()
        target = target.join(touched, partition, "left_semi")
    # the result is cut first because a table cannot be overwritten while it is being read
    merged = cut_lineage(upsert(target, source, keys, order))
    writer = merged.write.mode("overwrite")
    if partition is not None:
        writer = writer.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)


# --- registry tables ---------------------------------------------------------------------------


def model_registry(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """R-01: upsert by model version, first ``created_at`` kept, newest first."""
    merged = upsert_keep(rows, changes, ["model_version"], ["created_at"])
    return merged.orderBy(F.desc("created_at"), F.asc("model_version"))


def replay_campaigns(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """R-02: upsert by replay id, first ``created_at`` kept, newest first."""
    merged = upsert_keep(rows, changes, ["replay_id"], ["created_at"])
    return merged.orderBy(F.desc("created_at"), F.asc("replay_id"))


def audit_log(rows: DataFrame, target_type: str | None = None, limit: int | None = None) -> DataFrame:
    """R-03: audit rows, newest first."""
    found = rows if target_type is None else rows.filter(F.col("target_type") == target_type)
    ordered = found.orderBy(F.desc("created_at"), F.desc("audit_id"))
    return ordered if limit is None else ordered.limit(limit)
