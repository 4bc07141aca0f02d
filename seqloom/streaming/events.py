"""Event-level stream operators; all of them also run on batch frames of the same shape."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from seqloom.functions import scalars as S
from seqloom.functions.validate import Parsed, parse_events
from seqloom.operators.ordering import keep_first, number_rows
from seqloom.operators.requests import latency_stats
from seqloom.sources.store import Keyed, Store

# Stage names, versions and the size of the rolling latency sample.
FEATURE_VERSION = "sequence_v1"
ROLLING_SAMPLES = 5000
RING_COMPACT_EVERY = 20
DEFAULT_EVENT_TYPE = "pipeline_event"


def read_events(
    spark: SparkSession,
    source: str,
    topics: Mapping[str, str],
    servers: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """SRC-09: stream of (value, topic, event_type) from Kafka, or from JSON text files offline.

    ``topics`` maps topic to event type; a topic it does not name is a ``pipeline_event``. For files,
    ``source`` holds one folder ``topic=<name>`` per topic.
    """
    kinds = F.create_map(*[F.lit(x) for pair in topics.items() for x in pair])
    if servers is not None:
        raw = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .option("startingOffsets", "latest")
            .load()
        )
        rows = raw.select(
            F.col("value").cast("string").alias("value"), "topic",
            F.col("partition").cast("bigint").alias("part"), F.col("offset").alias("position"),
        )
    else:
        reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
        if files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", files_per_trigger)
        path = F.col("_metadata.file_path")
        rows = reader.load(source).select(
            "value",
            F.regexp_extract(path, r"topic=([^/]+)/", 1).alias("topic"),
            F.xxhash64(path).alias("part"),
        )
    return rows.withColumn("event_type", F.coalesce(F.try_element_at(kinds, F.col("topic")), F.lit(DEFAULT_EVENT_TYPE)))


def validated(stream: DataFrame) -> Parsed:
    """ST-02: stateless validation with a dead-letter side output."""
    return parse_events(stream)


def dedupe_across_batches(stream: DataFrame, ts: str = "event_time", delay: str = "10 minutes") -> DataFrame:
    """ST-03 option: drop repeated request ids across batches while the watermark remembers them."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["request_id"])


def feature_snapshots(events: DataFrame) -> DataFrame:
    """ST-17: feature hash, version and reference to the raw event."""
    meta = F.from_json("metadata", "map<string,string>")
    return events.select(
        "request_id",
        "protein_id",
        F.lit(FEATURE_VERSION).alias("feature_version"),
        S.feature_hash(F.col("protein_id"), F.col("sequence"), meta).alias("feature_hash"),
        F.concat(F.lit("cassandra://raw_protein_events/"), F.col("request_id")).alias("feature_payload_ref"),
    )


def route_events(events: DataFrame) -> dict[str, DataFrame]:
    """ST-08: data rows and status rows by event type.

    A prediction also completes its request, a dead letter also fails it.
    """
    kind = F.col("event_type")
    status = (
        F.when(kind == "prediction_result", "completed")
        .when(kind == "dead_letter", "failed")
        .otherwise(F.lower(F.coalesce("current_status", F.lit("processing"))))
    )
    known = kind.isin("request_status", "prediction_result", "dead_letter")
    return {
        "status": events.filter(known).withColumn("current_status", status),
        "prediction": events.filter(kind == "prediction_result"),
        "dead_letter": events.filter(kind == "dead_letter"),
    }


def live_status(stream: DataFrame) -> DataFrame:
    """ST-09: latest status per request, for update mode.

    Spark combines rows per request before the state lookup. State is one small row per request and
    is kept, because later statuses of a request may carry any ``created_at``; use the RocksDB state
    store for large streams.
    """
    return stream.groupBy("request_id").agg(
        F.max_by(F.lower("current_status"), F.struct("updated_at", "seq")).alias("current_status"),
        F.max("updated_at").alias("updated_at"),
        F.max_by("seq", F.struct("updated_at", "seq")).alias("seq"),
    )


CHANGES = "current_status string, change bigint"
#: Requests are followed in this many groups, as a call of Python for each request costs more than all its rows.
FOLLOWED_TOGETHER = 1 << 10
#: Stands for a missing time or number, before all others.
NO_PLACE = -(1 << 62)


def status_changes(stream: DataFrame, ttl: str = "24 hours", delay: str = "10 minutes") -> DataFrame:
    """ST-09: what each micro-batch changes in the number of requests per status: minus one for the status
    a request leaves, plus one for the one it takes.

    State is the latest status of each request, held for groups of requests by their hash. A request that has been
    silent for ``ttl`` of event time leaves the state and its status is taken back, so the state is bounded by the
    requests of that time. Rows later than ``delay`` are dropped.
    """
    ttl_ms = int(stream.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp_seconds(0) + INTERVAL {ttl})")).first()[0])
    read = ["request_id", "current_status", "at", "seq"]

    def follow(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {r[0]: r[1:] for r in zip(*state.get, strict=True)} if state.exists else {}
        now, before = state.getCurrentWatermarkMs(), {}
        for frame in () if state.hasTimedOut else frames:
            for request, status, at, seq in zip(*[frame[c].tolist() for c in read], strict=True):
                old = held.get(request)
                before.setdefault(request, None if old is None else old[0])
                if old is None or (at, seq) >= old[1:3]:
                    held[request] = (status, at, seq, now)
        changes = []
        for request, old in before.items():
            status, at, seq, _ = held[request]
            held[request] = (status, at, seq, max(at // 1000 + ttl_ms, now + 1))
            if old != status:
                changes += [(status, 1)] if old is None else [(old, -1), (status, 1)]
        for request in [r for r, (*_, until) in held.items() if until < now]:
            changes.append((held.pop(request)[0], -1))
        if held:
            state.update(tuple(map(list, zip(*[(r, *h) for r, h in held.items()], strict=True))))
            state.setTimeoutTimestamp(max(min(h[3] for h in held.values()), now))
        else:
            state.remove()
        if changes:
            yield pd.DataFrame(changes, columns=["current_status", "change"])

    place = lambda c: F.coalesce(c, F.lit(NO_PLACE))
    rows = stream.withWatermark("updated_at", delay).select(
        "request_id", "updated_at", F.lower("current_status").alias("current_status"),
        place(F.unix_micros("updated_at")).alias("at"), place(F.col("seq").cast("bigint")).alias("seq"),
        F.pmod(F.xxhash64("request_id"), F.lit(FOLLOWED_TOGETHER)).alias("_group"),
    )
    held = "request_id array<string>, current_status array<string>, at array<bigint>, seq array<bigint>, until array<bigint>"
    return rows.groupBy("_group").applyInPandasWithState(follow, CHANGES, held, "update", GroupStateTimeout.EventTimeTimeout)


def run_histogram(stream: DataFrame, store: Store, checkpoint: str, once: bool = False, ttl: str = "24 hours",
                  delay: str = "10 minutes", interval: str = "10 seconds") -> StreamingQuery:
    """ST-09: keep the live status histogram of :func:`read_histogram`; each batch counts once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("current_status").agg(F.sum("change").alias("change"))
        store.commit({"status_histogram": summed}, "histogram", batch_id)

    writer = status_changes(stream, ttl, delay).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def read_histogram(store: Store) -> DataFrame:
    """Live requests per status."""
    summed = store.read("status_histogram").groupBy("current_status").agg(F.sum("change").alias("n"))
    return summed.filter("n <> 0")


def events_per_minute(stream: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """ST-10: event-time counts per minute; rows later than ``delay`` are dropped and counted by
    ``numRowsDroppedByWatermark``.
    """
    counted = stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 minute").alias("_w"))
    return counted.agg(F.count("*").alias("metric_value")).select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        F.lit("events_per_minute").alias("metric_name"),
        "metric_value",
    )


def rolling_latency(samples: DataFrame, order: Sequence[Column], n: int = ROLLING_SAMPLES) -> DataFrame:
    """ST-11: mean and p95 over the newest ``n`` samples, zeros included; ``order`` is newest first."""
    return latency_stats(samples.filter(F.col("latency_ms").isNotNull()).orderBy(*order).limit(n), positive_only=False)


#: The ring of the newest latency samples, one row per place.
LATENCY_RING = {"latency_ring": Keyed(("place",), buckets=1)}


def run_latency(stream: DataFrame, store: Store, checkpoint: str, order: Sequence[str] = ("updated_at", "seq"),
                n: int = ROLLING_SAMPLES, once: bool = False, interval: str = "10 seconds") -> StreamingQuery:
    """ST-11 as a stream: keep the newest ``n`` latency samples in the table ``latency_ring``.

    Each batch merges its newest ``n`` with those held, whatever order they arrive in; both are bounded, so
    a batch costs its own rows and ``n`` more. ``rolling_latency`` of the ring equals that of all samples.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if store.is_committed("latency", batch_id):
            return
        newest_first = [F.desc(c) for c in order]
        samples = batch.filter("latency_ms IS NOT NULL").select("latency_ms", *order)
        if "latency_ring" in store.state()["tables"]:
            samples = samples.unionByName(store.read("latency_ring").drop("place"))
        ring = samples.orderBy(*newest_first).limit(n)  # at most n rows, which one task numbers
        placed = ring.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*newest_first)))
        store.commit({"latency_ring": placed}, "latency", batch_id)
        if batch_id % RING_COMPACT_EVERY == RING_COMPACT_EVERY - 1:
            store.compact("latency_ring")
            store.vacuum()

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()


def _pick(obj: Column, *paths: str) -> Column:
    return F.coalesce(*[F.nullif(F.get_json_object(obj, p), F.lit("")) for p in paths])


def retry_events(payloads: DataFrame, value: str = "payload") -> DataFrame:
    """ST-12: event rebuilt from a retry payload (JSON text).

    The event sits under ``raw_event`` or ``payload`` or is the payload itself.
    """
    top = F.col(value)
    inner = F.coalesce(F.get_json_object(top, "$.raw_event"), F.get_json_object(top, "$.payload"), top)
    known = F.from_json(F.get_json_object(inner, "$.metadata"), "map<string,string>")
    count = F.coalesce(
        _pick(top, "$.retry_count").try_cast("int"),
        _pick(inner, "$.metadata.retry_count").try_cast("int"),
        F.lit(0),
    )
    extra = F.create_map(
        F.lit("retry_count"), count.cast("string"),
        F.lit("retry_source"), F.coalesce(_pick(top, "$.source"), F.lit("retry_worker")),
    )
    none = F.create_map().cast("map<string,string>")
    sequence = S.normalize_sequence(F.coalesce(_pick(inner, "$.sequence", "$.sequence_raw"), F.lit("")))
    return payloads.select(
        F.coalesce(_pick(inner, "$.request_id"), _pick(top, "$.request_id")).alias("request_id"),
        F.coalesce(_pick(inner, "$.protein_id"), _pick(top, "$.protein_id")).alias("protein_id"),
        sequence.alias("sequence"),
        F.coalesce(_pick(inner, "$.source"), _pick(top, "$.source"), F.lit("retry_worker")).alias("source"),
        S.checksum(sequence, _pick(inner, "$.checksum")).alias("checksum"),
        count.alias("retry_count"),
        S.sorted_json(F.map_concat(F.coalesce(known, none), extra)).alias("metadata"),
    )


def retry_failures(failures: DataFrame, raw: DataFrame) -> DataFrame:
    """ST-12: retryable failures joined to their raw events, retry count raised by one."""
    again = failures.filter("retryable").groupBy("request_id").agg(
        (F.max(F.coalesce("retry_count", F.lit(0))) + 1).alias("retry_count")
    )
    return raw.join(again, "request_id").withColumn("current_status", F.lit("RETRYING"))


def replay(records: DataFrame, campaign: str, order: Sequence[str], every: int | None = None,
           limit: int | None = None, metadata: Mapping[str, str] | None = None) -> DataFrame:
    """ST-13: replay events of a campaign, numbered from 1; every ``every``-th sequence is broken.

    ``accepted`` tells whether the event passes validation.
    """
    first = records if limit is None else records.orderBy(*order).limit(limit)
    numbered = number_rows(first, order, name="replay_index")
    broken = F.lit(False) if not every else F.col("replay_index") % every == 0
    sequence = S.normalize_sequence(F.when(broken, F.concat("sequence", F.lit("*"))).otherwise(F.col("sequence")))
    base = [F.lit(x) for pair in (metadata or {}).items() for x in pair]
    meta = F.create_map(
        *base, F.lit("campaign_id"), F.lit(campaign), F.lit("producer_id"), F.lit("replay_service"),
        F.lit("replay_index"), F.col("replay_index").cast("string"),
    )
    return numbered.select(
        "replay_index",
        "protein_id",
        sequence.alias("sequence"),
        S.sorted_json(meta).alias("metadata"),
        S.sequence_error(sequence, "event").isNull().alias("accepted"),
    )


def replay_counts(events: DataFrame) -> DataFrame:
    """ST-13: emitted, accepted and failed events of a campaign."""
    ok = F.col("accepted").cast("bigint")
    return events.agg(
        F.count("*").alias("emitted"),
        F.coalesce(F.sum(ok), F.lit(0)).alias("accepted"),
        F.coalesce(F.sum(1 - ok), F.lit(0)).alias("failed"),
    )


def complete_requests(chunks: DataFrame) -> DataFrame:
    """ST-14: one completed row per request from its chunk results.

    ``chunks``: request_id, chunk_index, protein_id, latency_ms, model_version, one row per protein
    result. Chunks are folded before requests are.
    """
    per_chunk = chunks.groupBy("request_id", "chunk_index").agg(
        F.max("latency_ms").alias("latency_ms"),
        F.count("*").alias("n"),
        F.max("model_version").alias("model_version"),
    )
    return per_chunk.groupBy("request_id").agg(
        F.max("latency_ms").alias("latency_ms"),
        F.sum("n").alias("protein_result_count"),
        F.count("*").alias("modal_chunk_count"),
        F.max_by("model_version", "chunk_index").alias("model_version"),
        F.lit("completed").alias("current_status"),
        F.lit("prediction_written").alias("stage_name"),
    )


def analysis_from_batch(wanted: DataFrame, rows: DataFrame, k: int = 20) -> DataFrame:
    """ST-15: best ``k`` terms per wanted protein of a batch; if none match, those of all rows.

    ``wanted``: batch_id, protein_id. ``rows``: batch_id, protein_id, term, score. The fallback
    ranks a batch once and hands out only its best ``k`` rows.
    """
    order = [F.desc("score"), F.asc("term")]
    best = keep_first(rows, ["batch_id", "protein_id"], order, k)
    own = wanted.join(best, ["batch_id", "protein_id"])
    missing = wanted.join(rows.select("batch_id", "protein_id"), ["batch_id", "protein_id"], "left_anti")
    shared = keep_first(rows.drop("protein_id"), ["batch_id"], order, k)
    return own.unionByName(missing.join(shared, "batch_id"))
