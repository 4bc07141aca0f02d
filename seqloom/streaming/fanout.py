"""Events to serving tables: what a status, a prediction or a failure writes, all in one commit.

Tables are those of ``VIEW_KEYS``. The four request windows (day, status, user, protein) are not stored
again: they are ``request_status_by_id`` with bucket columns, so a request never stays in a bucket it left.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqloom.functions import scalars as S
from seqloom.operators.lineage import cut_lineage, cuts_dropped
from seqloom.operators.requests import VIEW_KEYS
from seqloom.sources.store import Keyed, Store
from seqloom.streaming.events import route_events

WINDOWS = ("requests_by_day", "requests_by_status_window", "requests_by_user_window", "requests_by_protein_window")
#: What makes a row of a view newer; the others take the later commit.
_orders = {
    "request_status_by_id": ("updated_at",),
    "request_proteins_by_request": ("updated_at",),
    "protein_requests_by_protein": ("updated_at",),
    "latest_prediction_by_protein": ("predicted_at",),
    "prediction_by_request": ("predicted_at",),
}
# rejected messages share the request id "unknown", so their failures are told apart by arrival too
VIEWS: dict[str, Keyed] = {
    name: Keyed((*keys, "seq") if name == "failed_requests_by_time" else keys, _orders.get(name, ()), ("created_at",) if name == "request_status_by_id" else (), ("seq",))
    for name, keys in VIEW_KEYS.items()
    if name not in WINDOWS
}

#: Fields of events of all types; texts where producers differ in form.
EVENT = (
    "request_id string, protein_id string, current_status string, status string, username string, source string, "
    "created_at string, updated_at string, event_ts string, predicted_at string, failed_at string, error_code string, "
    "error_message string, message string, stage_name string, retry_count int, model_version string, feature_version string, "
    "latency_ms int, sequence_length int, retryable boolean, threshold double, threshold_used double, confidence_summary string, "
    "top_terms array<string>, predicted_terms array<string>, score_map map<string,double>, predictions array<string>, "
    "input_records array<struct<protein_id:string,id:string,sequence_length:int,sequence:string,description:string>>"
)


def read_view(store: Store, name: str) -> DataFrame:
    """V-01: a serving table, or one of the request windows over the status table."""
    if name not in WINDOWS:
        return store.read(name)
    rows = store.read("request_status_by_id")
    keys = S.bucket_keys(F.col("created_at"), F.col("current_status"), F.col("username"), F.col("protein_id"))
    return rows.withColumns(keys)


def _links(rows: DataFrame, status: Column, stage: Column) -> DataFrame:
    """A row per record of a request, or for its own protein where it lists none."""
    own = F.array(F.struct(F.col("protein_id").alias("protein_id"), F.col("sequence_length").alias("n"), F.lit(None).cast("string").alias("description")))
    listed = F.transform(
        "input_records",
        lambda r: F.struct(
            F.coalesce(F.nullif(r["protein_id"], F.lit("")), r["id"]).alias("protein_id"),
            F.coalesce(r["sequence_length"], F.length(r["sequence"])).alias("n"),
            r["description"].alias("description"),
        ),
    )
    records = F.when(F.size("input_records") > 0, listed).otherwise(own)
    spread = rows.select("*", F.explode(records).alias("_record"))
    return spread.select(
        "request_id", F.trim("_record.protein_id").alias("protein_id"), S.local_day(F.col("created_at")).alias("request_date"),
        "created_at", "updated_at", "username", "source", status.alias("current_status"), stage.alias("stage_name"),
        F.col("_record.n").alias("sequence_length"), F.col("_record.description").alias("description"),
        "model_version", "feature_version", "seq",
    ).filter("protein_id <> ''")


def _timeline(rows: DataFrame, at: str, kind: str, status: Column, stage: Column, message: Column) -> DataFrame:
    return rows.select(
        "request_id", F.col(at).alias("event_ts"), F.lit(kind).alias("event_type"), stage.alias("stage_name"),
        status.alias("status"), message.alias("message"), "latency_ms", "seq",
    )


def fan_out(status: DataFrame, predictions: DataFrame, failures: DataFrame) -> dict[str, DataFrame]:
    """ST-06, ST-07: rows of every serving table for typed events.

    All three share the typed columns of :func:`typed`; ``status`` has a row for each change of a
    request, those of predictions and failures included.
    """
    done = F.lit("completed")
    written = F.lit("prediction_written")
    state, stage = F.col("current_status"), F.col("stage_name")
    links = _links(status, state, stage).unionByName(_links(predictions.withColumn("input_records", F.lit(None).cast(status.schema["input_records"].dataType)).withColumn("updated_at", F.col("predicted_at")), done, written))
    timeline = (
        _timeline(status, "updated_at", "request_status", state, stage, F.col("error_message"))
        .unionByName(_timeline(predictions, "predicted_at", "prediction_result", done, written, F.col("confidence_summary")))
        .unionByName(_timeline(failures, "failed_at", "dead_letter", F.lit("failed"), stage, F.col("error_message")))
    )
    results = predictions.select(
        "request_id", "protein_id", "predicted_at", "model_version", "feature_version", "predicted_terms", "score_map",
        "prediction_rows", "threshold_used", "latency_ms", "confidence_summary", "seq",
    )
    failed = failures.select(
        F.to_date("failed_at").alias("failure_date"), F.coalesce("error_code", F.lit("UNKNOWN")).alias("status_code"), "failed_at",
        "request_id", "protein_id", "stage_name", F.col("error_message").alias("reason"), F.coalesce("retryable", F.lit(False)).alias("retryable"), "seq",
    )
    rows = status.select(
        "request_id", "protein_id", "username", "source", "created_at", "updated_at", "current_status", "stage_name",
        "error_code", "error_message", "retry_count", "model_version", "feature_version", "seq",
    )
    return {
        "request_status_by_id": rows,
        "request_timeline_by_id": timeline,
        "request_proteins_by_request": links,
        "protein_requests_by_protein": links,
        "latest_prediction_by_protein": results,
        "prediction_history_by_protein": results,
        "prediction_by_request": results,
        "failed_requests_by_time": failed,
    }


def typed(events: DataFrame, now: datetime) -> DataFrame:
    """Columns of JSON events (``value``, ``event_type``, ``seq``), defaults filled in."""
    stamp = F.lit(now.astimezone(UTC).strftime("%Y-%m-%d %H:%M:%S.%f") + "+00:00").cast("timestamp")
    at = lambda *names: F.coalesce(*[S.parse_ts(F.col(f"_e.{n}"), "+00:00") for n in names], stamp)
    or_else = lambda name, other: F.coalesce(f"_e.{name}", F.lit(other))
    terms = F.coalesce(F.col("_e.top_terms"), F.col("_e.predicted_terms"), F.array().cast("array<string>"))
    parsed = events.select("event_type", "seq", F.inline(F.array(F.struct(F.from_json("value", EVENT).alias("_e")))))
    named = parsed.select(
        "event_type", "seq", "_e.request_id", F.coalesce("_e.protein_id", F.lit("")).alias("protein_id"),
        F.lower(F.coalesce("_e.current_status", "_e.status", F.lit("processing"))).alias("current_status"),
        or_else("username", "system").alias("username"), or_else("source", "pipeline").alias("source"),
        at("created_at", "event_ts").alias("created_at"), at("updated_at", "event_ts").alias("updated_at"),
        at("predicted_at", "event_ts").alias("predicted_at"), at("failed_at", "event_ts").alias("failed_at"),
        "_e.error_code", F.coalesce("_e.error_message", "_e.message").alias("error_message"), "_e.stage_name",
        F.coalesce("_e.retry_count", F.lit(0)).alias("retry_count"), "_e.model_version", "_e.feature_version",
        F.coalesce("_e.latency_ms", F.lit(0)).alias("latency_ms"), "_e.sequence_length", "_e.retryable",
        F.coalesce("_e.threshold_used", "_e.threshold").alias("threshold_used"), "_e.confidence_summary", "_e.input_records",
        F.col("_e.score_map").alias("_map"), F.coalesce("_e.predictions", F.array().cast("array<string>")).alias("_rows"),
        # a term is an object with its score, or just its name
        F.transform(terms, lambda t: F.struct(
            F.coalesce(F.get_json_object(t, "$.term_id"), F.get_json_object(t, "$.go_term"), t).alias("term"),
            F.coalesce(F.get_json_object(t, "$.score").cast("double"), F.lit(0.0)).alias("score"), t.startswith("{").alias("whole"), t.alias("json"),
        )).alias("_terms"),
    )
    rows = F.when(F.size("_rows") > 0, F.col("_rows")).otherwise(F.transform(F.filter("_terms", lambda t: t["whole"]), lambda t: t["json"]))
    scores = F.coalesce("_map", F.map_from_entries(F.transform("_terms", lambda t: F.struct(t["term"], t["score"]))))
    return named.select(
        *[c for c in named.columns if not c.startswith("_")],
        F.col("_terms.term").alias("predicted_terms"), scores.alias("score_map"), rows.alias("prediction_rows"),
    )


def persist_events(batch: DataFrame, batch_id: int, store: Store, now: datetime | None = None) -> None:
    """ST-06 to ST-08: one micro-batch of events to every serving table, in one commit.

    Events without a request id or that are no JSON objects are dropped, as nothing could be keyed by them;
    other types than status, prediction and dead letter write no table.
    """
    if store.is_committed("fanout", batch_id):
        return
    with cuts_dropped(batch.sparkSession):
        numbered = batch.select("value", "event_type", F.monotonically_increasing_id().alias("seq"))
        events = cut_lineage(typed(numbered, now or datetime.now(UTC)).filter("request_id IS NOT NULL"))
        parts = route_events(events)
        # a prediction or failure changes its request at its own time
        own = F.when(F.col("event_type") == "prediction_result", F.col("predicted_at")).when(F.col("event_type") == "dead_letter", F.col("failed_at"))
        status = parts["status"].withColumn("updated_at", F.coalesce(own, "updated_at"))
        store.commit(fan_out(status, parts["prediction"], parts["dead_letter"]), "fanout", batch_id)


def run_fanout(stream: DataFrame, store: Store, checkpoint: str, once: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """ST-07, ST-08: keep the serving tables up to date with a stream of (value, event_type)."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: persist_events(batch, batch_id, store)
    )
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def view_store(spark: SparkSession, root: str, more: Mapping[str, Keyed] | None = None) -> Store:
    """A store whose serving tables are keyed as ``VIEW_KEYS`` says."""
    return Store(spark, root, VIEWS | dict(more or {}))
