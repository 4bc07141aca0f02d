"""Request listings, dashboards, timelines and serving views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.operators.agg import nearest_ranks
from seqloom.operators.dedupe import latest_requests
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import keep_first


# Status names, list sizes and the tables each event type is written to.
KNOWN_STATUSES = ("pending", "processing", "completed", "failed", "retrying", "cancelled")
DASHBOARD_ROWS = 10
ERROR_ROWS = 8
THROUGHPUT_MINUTES = 8
ZONE_HOURS = 7
STATUS_TABLES = (
    "request_status_by_id", "requests_by_day", "requests_by_status_window", "requests_by_user_window",
    "requests_by_protein_window", "request_proteins_by_request", "protein_requests_by_protein",
    "request_timeline_by_id",
)
PREDICTION_TABLES = (
    "latest_prediction_by_protein", "prediction_history_by_protein", "request_proteins_by_request",
    "protein_requests_by_protein", "request_timeline_by_id",
)
#: Tables whose writes the dashboard counts, by what they have a row for (fixed values).
WRITES_OF = {
    "requests": (
        "request_status_by_id", "requests_by_day", "requests_by_status_window",
        "requests_by_user_window", "requests_by_protein_window",
    ),
    "proteins": ("request_proteins_by_request", "protein_requests_by_protein"),
    "stages": ("request_timeline_by_id",),
    "predictions": ("latest_prediction_by_protein", "prediction_history_by_protein", "prediction_by_request"),
}


# --- filters and projections -------------------------------------------------------------------


def visible_to(df: DataFrame, user: str, admin: bool = False) -> DataFrame:
    """F-01: an admin sees everything, a user sees own rows."""
    return df if admin else df.filter(F.col("username") == user)


def day_range(day: date, days: int = 1) -> tuple[datetime, datetime]:
    """UTC bounds of ``days`` local days ending with ``day``, as plain times for pushdown."""
    last = datetime(day.year, day.month, day.day) - timedelta(hours=ZONE_HOURS)
    return last - timedelta(days=days - 1), last + timedelta(days=1)


def _between(ts: str, bounds: tuple[datetime, datetime]) -> Column:
    low, high = (F.lit(b.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") for b in bounds)
    return (F.col(ts) >= low) & (F.col(ts) < high)


def last_days(df: DataFrame, days: int, today: date, ts: str = "created_at") -> DataFrame:
    """F-03: rows of the last ``days`` local days; a constant range that reaches the scan."""
    return df.filter(_between(ts, day_range(today, days)))


def list_requests(df: DataFrame, day: date, status: str | None = None, user: str | None = None,
                  limit: int = 200) -> DataFrame:
    """F-02: newest requests of a local day, optionally of one status and of one user."""
    rows = df.filter(_between("created_at", day_range(day)))
    newest = "created_at"
    if status is not None:
        rows, newest = rows.filter(F.lower("current_status") == status.lower()), "updated_at"
    if user is not None:
        rows = rows.filter(F.col("username") == user)
    return rows.orderBy(F.desc(newest), F.asc("request_id")).limit(limit)


def to_request(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """F-05: public request shape; ``aliases`` may map status names (none by default)."""
    status = F.lower(F.coalesce("current_status", F.lit("processing")))
    if aliases:
        table = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
        status = F.coalesce(F.try_element_at(table, status), status)
    plain = ("stage_name", "error_code", "error_message", "model_version", "feature_version")
    return df.select(
        F.coalesce("request_id", F.lit("")).alias("request_id"),
        F.coalesce("protein_id", F.lit("")).alias("protein_id"),
        "username", "source",
        F.coalesce("created_at", "updated_at").alias("created_at"),
        "updated_at",
        status.alias("current_status"),
        *plain,
        F.coalesce("retry_count", F.lit(0)).alias("retry_count"),
    )


def to_status_event(df: DataFrame, extra: Column | None = None) -> DataFrame:
    """F-06: request row as a JSON event; keys of the string map ``extra`` override."""
    fields = [c for c in df.columns if c not in ("sequence", "metadata")]
    pairs = [x for c in fields for x in (F.lit(c), F.col(c).cast("string"))]
    body = F.create_map(*pairs, F.lit("event_ts"), F.coalesce("updated_at", "created_at").cast("string"))
    if "sequence" in df.columns:
        measured = F.create_map(
            F.lit("sequence"), F.col("sequence"),
            F.lit("sequence_length"), F.length("sequence").cast("string"),
        )
        body = F.when(F.col("sequence").isNull(), body).otherwise(F.map_concat(body, measured))
    if "metadata" in df.columns:
        noted = F.create_map(F.lit("metadata"), F.col("metadata"))
        body = F.when(F.col("metadata").isNull(), body).otherwise(F.map_concat(body, noted))
    if extra is not None:
        none = F.create_map().cast("map<string,string>")
        body = F.map_concat(body, F.coalesce(extra, none))
    return df.select("request_id", body.alias("event"))


def request_predictions(df: DataFrame, request_id: str) -> DataFrame:
    """F-07: predictions of a request without batch labels, by protein then time."""
    rows = df.filter((F.col("request_id") == request_id) & ~S.is_batch_label(F.col("protein_id")))
    return rows.orderBy(F.lower("protein_id"), "predicted_at")


def latest_visible(predictions: DataFrame, requests: DataFrame, protein: str, user: str, admin: bool = False) -> DataFrame:
    """F-08: newest prediction of a protein among requests the user may see."""
    rows = predictions.filter(F.lower("protein_id") == protein.lower())
    if not admin:
        rows = rows.join(visible_to(requests, user).select("request_id"), "request_id", "left_semi")
    return rows.orderBy(F.desc("predicted_at"), F.asc("request_id")).limit(1)


# --- windows, pages and timelines --------------------------------------------------------------


def page(df: DataFrame, page_number: int, size: int, order: Sequence[Column]) -> DataFrame:
    """W-03: one page and ``has_next``, decided by one row beyond it. ``order`` must be unique.

    All rows before the page are sorted; walks over many pages use ``page_after``.
    """
    start = (page_number - 1) * size
    return _cut_page(df.orderBy(*order).limit(start + size + 1), start, size, order)


def _cut_page(fetched: DataFrame, start: int, size: int, order: Sequence[Column]) -> DataFrame:
    """Rows ``start`` to ``start + size`` of the few ``fetched`` ones, in order, with ``has_next``."""
    placed = fetched.withColumns(
        {
            "_place": F.row_number().over(Window.orderBy(*order)),
            "has_next": F.count("*").over(Window.partitionBy()) > start + size,
        }
    )
    inside = F.col("_place").between(start + 1, start + size)
    return placed.filter(inside).orderBy("_place").drop("_place")


def _beyond(col: str, down: bool, value) -> Column:
    """Rows that come after ``value`` in an order where null is the lowest value."""
    if value is None:
        return F.lit(False) if down else F.col(col).isNotNull()
    return (F.col(col) < F.lit(value)) | F.col(col).isNull() if down else F.col(col) > F.lit(value)


def page_after(df: DataFrame, size: int, order: Sequence[tuple[str, bool]], last: Sequence | None = None) -> DataFrame:
    """W-03 by seek key: the ``size`` rows after the row whose order columns are ``last``, and ``has_next``.

    ``order`` names columns and whether they go down; together they must be unique. Rows before the
    page are left out by a filter on the leading column, which reaches the scan, so a late page
    costs no more than the first. Without ``last`` it is the first page.
    """
    sort = [F.desc(c) if down else F.asc(c) for c, down in order]
    if last is not None:
        same, after = F.lit(True), F.lit(False)
        for (col, down), value in zip(order, last, strict=True):
            after = after | (same & _beyond(col, down, value))
            same = same & F.col(col).eqNullSafe(F.lit(value))
        (lead, down), value = order[0], last[0]
        df = df.filter(_beyond(lead, down, value) | F.col(lead).eqNullSafe(F.lit(value))).filter(after)
    return _cut_page(df.orderBy(*sort).limit(size + 1), 0, size, sort)


def latest_n(df: DataFrame, keys: Sequence[str], n: int, ts: str, tie: str = "request_id") -> DataFrame:
    """W-04: newest ``n`` rows per key."""
    return keep_first(df, keys, [F.desc(ts), F.asc(tie)], n)


def timeline(df: DataFrame, request_id: str, n: int | None = None) -> DataFrame:
    """W-05: events of a request in time order, or its newest ``n`` in time order."""
    rows = df.filter(F.col("request_id") == request_id)
    if n is not None:
        rows = rows.orderBy(F.desc("event_ts"), F.desc("event_type")).limit(n)
    return rows.orderBy("event_ts", "event_type")


def recent(df: DataFrame, n: int = DASHBOARD_ROWS, ts: str = "updated_at", tie: str = "request_id") -> DataFrame:
    """W-06: newest ``n`` rows."""
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(n)


def metric_points(df: DataFrame, name: str, n: int) -> DataFrame:
    """W-09: newest ``n`` windows of a metric."""
    return df.filter(F.col("metric_name") == name).orderBy(F.desc("window_start")).limit(n)


# --- dashboard aggregates ----------------------------------------------------------------------


def status_counts(latest: DataFrame) -> DataFrame:
    """A-16: requests per status; known statuses appear even at zero."""
    spark = latest.sparkSession
    zeros = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in KNOWN_STATUSES])).alias("current_status"))
    counted = latest.groupBy("current_status").agg(F.count("*").alias("n"))
    both = counted.unionByName(zeros.withColumn("n", F.lit(0).cast("bigint")))
    return both.groupBy("current_status").agg(F.sum("n").alias("n"))


def error_counts(latest: DataFrame, n: int = ERROR_ROWS) -> DataFrame:
    """A-17: most frequent error codes of failed requests."""
    code = F.coalesce(F.nullif("error_code", F.lit("")), F.lit("UNKNOWN")).alias("error_code")
    failed = latest.filter(F.col("current_status") == "failed")
    return failed.groupBy(code).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc("error_code")).limit(n)


def error_rate(latest: DataFrame) -> DataFrame:
    """A-18: failed share, four decimals, 0 for no requests."""
    failed = (F.col("current_status") == "failed").cast("double")
    return latest.agg(F.coalesce(F.bround(F.avg(failed), 4), F.lit(0.0)).alias("error_rate"))


def latency_stats(df: DataFrame, positive_only: bool = True, c: str = "latency_ms") -> DataFrame:
    """A-19: rounded mean and nearest-rank p95, 0 for no values."""
    values = df.filter(F.col(c).isNotNull())
    if positive_only:
        values = values.filter(F.col(c) > 0)
    mean = values.agg(F.bround(F.avg(c)).cast("bigint")).scalar()
    ranked = nearest_ranks(values, c, {"p95_latency_ms": 0.95})
    zero = F.lit(0).cast("bigint")
    return ranked.select(
        F.coalesce(mean, zero).alias("avg_latency_ms"),
        F.coalesce(F.col("p95_latency_ms").cast("bigint"), zero).alias("p95_latency_ms"),
    )


def request_latency(timeline_rows: DataFrame) -> DataFrame:
    """A-20: largest positive latency on each request's timeline."""
    return timeline_rows.filter(F.col("latency_ms") > 0).groupBy("request_id").agg(F.max("latency_ms").alias("latency_ms"))


def throughput(df: DataFrame, now: datetime, minutes: int = THROUGHPUT_MINUTES, ts: str = "created_at") -> DataFrame:
    """A-21: rows per minute for the last minutes up to ``now`` (UTC), zero-filled."""
    last = now.replace(second=0, microsecond=0)
    first = last - timedelta(minutes=minutes - 1)
    counts = (
        df.filter(_between(ts, (first, last + timedelta(minutes=1))))
        .groupBy(F.date_trunc("minute", ts).alias("window_start"))
        .agg(F.count("*").alias("_n"))
    )
    stamp = lambda t: F.lit(t.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    grid = df.sparkSession.range(1).select(
        F.explode(F.sequence(stamp(first), stamp(last), F.expr("interval 1 minute"))).alias("window_start")
    )
    return grid.join(counts, "window_start", "left").select(
        "window_start",
        (F.col("window_start") + F.expr("interval 1 minute")).alias("window_end"),
        F.lit("events_per_minute").alias("metric_name"),
        F.coalesce("_n", F.lit(0)).alias("metric_value"),
    )


def batch_metrics(flagged: DataFrame) -> DataFrame:
    """A-22: counters of one micro-batch from rows flagged ``arrived``, ``valid``, ``kept``, ``scored``
    and ``failed``.
    """
    total = lambda c: F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0))
    return flagged.agg(
        total("arrived").alias("input_events"),
        total("valid").alias("valid_events"),
        (total("valid") - total("kept")).alias("duplicate_events"),
        total("scored").alias("predictions"),
        total("failed").alias("failures"),
        F.coalesce(F.max("latency_ms"), F.lit(0)).cast("bigint").alias("latency_ms"),
    )


def write_amplification(events: DataFrame) -> DataFrame:
    """A-23: rows written per serving table, from counts per event type."""
    tables = F.when(F.col("event_type") == "request_status", F.array(*map(F.lit, STATUS_TABLES))).when(
        F.col("event_type") == "prediction_result", F.array(*map(F.lit, PREDICTION_TABLES))
    )
    counts = events.groupBy("event_type").agg(F.count("*").alias("_n"))
    return counts.select(F.explode(tables).alias("table_name"), "_n").groupBy("table_name").agg(F.sum("_n").alias("writes"))


def total_today(latest: DataFrame, today: date, ts: str = "updated_at") -> DataFrame:
    """A-24: requests whose last change is on the local day."""
    return latest.filter(_between(ts, day_range(today))).agg(F.count("*").alias("total_today"))


def dashboard_counts(requests: DataFrame, links: DataFrame, predictions: DataFrame) -> DataFrame:
    """A-25: proteins of the visible requests (1 for a request without records) and their predictions."""
    sizes = links.groupBy("request_id").agg(F.count("*").alias("_size"))
    proteins = (
        requests.join(sizes, "request_id", "left")
        .agg(F.coalesce(F.sum(F.coalesce("_size", F.lit(1))), F.lit(0)).alias("protein_count"))
    )
    distinct = predictions.join(requests, "request_id", "left_semi").select("request_id", "protein_id").distinct()
    n = distinct.agg(F.count("*")).scalar()
    return proteins.select("protein_count", n.alias("prediction_count"))


def dashboard_totals(rows: DataFrame, latest: DataFrame, predicted: DataFrame, links: DataFrame, day: date) -> DataFrame:
    """A-25, A-26: one row of how many requests, proteins, stages and predictions a day has.

    ``rows`` is the status log, ``latest`` its newest row per request, ``predicted`` has a row per
    (request, protein), ``links`` one per record of a request; a request without records counts as one.
    """
    sizes = links.groupBy("request_id").agg(F.count("*").alias("_size"))
    proteins = latest.join(sizes, "request_id", "left").agg(F.coalesce(F.sum(F.coalesce("_size", F.lit(1))), F.lit(0)).alias("proteins"))
    requests = total_today(latest, day).scalar()
    stages = F.greatest(requests, rows.agg(F.count("*")).scalar())
    predictions = predicted.agg(F.count("*")).scalar()
    return proteins.select(requests.alias("requests"), "proteins", stages.alias("stages"), predictions.alias("predictions"))


def dashboard_summary(status_log: DataFrame, predictions: DataFrame, links: DataFrame, user: str, admin: bool, day: date,
                      now: datetime) -> DataFrame:
    """A-26: the operations dashboard as (section, item, value) rows, from one day of the logs.

    The day range reaches both scans; everything after it works on one row per request or per
    (request, protein). An admin sees all predictions of the day, a user those of own requests.
    """
    rows = visible_to(last_days(status_log, 1, day), user, admin)
    latest = cut_lineage(latest_requests(rows))  # read by every section below
    item = lambda df, section, name, value: df.select(
        F.lit(section).alias("section"), name.alias("item"), value.cast("double").alias("value")
    )
    made = last_days(predictions, 1, day, "predicted_at")
    if not admin:
        made = made.join(latest, "request_id", "left_semi")
    predicted = cut_lineage(made.groupBy("request_id", "protein_id").agg(F.max("predicted_at").alias("predicted_at")))
    totals = cut_lineage(dashboard_totals(rows, latest, predicted, links, day))
    writes = [F.struct(F.lit(t).alias("table"), F.col(of).alias("n")) for of, tables in WRITES_OF.items() for t in tables]
    newest = predicted.orderBy(F.desc("predicted_at"), "request_id", "protein_id").limit(DASHBOARD_ROWS)
    stats = latency_stats(request_latency(rows))
    minute = F.date_format("window_start", "yyyy-MM-dd HH:mm")
    parts = [
        item(status_counts(latest), "status", F.col("current_status"), F.col("n")),
        item(error_counts(latest), "error", F.col("error_code"), F.col("n")),
        item(error_rate(latest), "rate", F.lit("error_rate"), F.col("error_rate")),
        item(totals, "total", F.lit("total_today"), F.col("requests")),
        item(totals, "total", F.lit("protein_count"), F.col("proteins")),
        item(totals, "total", F.lit("prediction_count"), F.col("predictions")),
        item(totals.select(F.inline(F.array(*writes))), "writes", F.col("table"), F.col("n")),
        item(newest, "recent_prediction", F.concat_ws(" ", "request_id", "protein_id"), F.unix_timestamp("predicted_at")),
        item(stats, "latency", F.lit("avg_latency_ms"), F.col("avg_latency_ms")),
        item(stats, "latency", F.lit("p95_latency_ms"), F.col("p95_latency_ms")),
        item(throughput(latest, now), "throughput", minute, F.col("metric_value")),
        item(recent(latest), "recent_request", F.col("request_id"), F.unix_timestamp("updated_at")),
        item(
            recent(latest.filter(F.col("current_status") == "failed")),
            "recent_failure", F.col("request_id"), F.unix_timestamp("updated_at"),
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def last_event_at(events: DataFrame, ts: str = "ts") -> DataFrame:
    """A-43."""
    return events.agg(F.max(ts).alias("last_event_at"))


def request_progress(events: DataFrame) -> DataFrame:
    """A-38: percent done per request from its model-stream events.

    Columns: request_id, seq, event_type, modal_event, modal_step, current_status, total_chunks,
    chunk_index, total_batches, batch_index (the last four nullable). Two aggregation levels: per
    (request, chunk), then per request.
    """
    kind, step = F.col("modal_event"), F.col("modal_step")
    chunked = (F.coalesce("total_chunks", F.lit(0)) > 1) | F.col("chunk_index").isNotNull()
    batches = F.greatest(F.lit(1), F.coalesce("total_batches", F.lit(1)))
    position = F.least(batches, F.coalesce("batch_index", F.lit(-1)) + 1)
    in_chunk = (F.coalesce("total_chunks", F.lit(0)) > 1) & (F.coalesce("chunk_index", F.lit(-1)) >= 0)
    moved = in_chunk & kind.isin("batch", "chunk_done")
    done_part = F.when(kind == "chunk_done", 1.0).when(position > 0, position / batches).otherwise(0.0)
    single = (kind == "batch") & ~chunked & (position > 0)
    flag = lambda c: F.max(F.coalesce(c, F.lit(False)).cast("int"))
    # the first event to reach the highest position tells the total
    best = F.struct(position.alias("p"), (-F.col("seq")).alias("s"), batches.alias("b"))
    per_chunk = events.groupBy("request_id", F.when(in_chunk, F.col("chunk_index")).alias("_chunk")).agg(
        flag((kind == "start") | (kind == "batch") | ((kind == "progress") & (step == "normalize_input"))).alias("_seen"),
        flag((kind == "batch") | ((kind == "progress") & (step == "batch_started"))).alias("_started"),
        flag(
            ((kind == "done") & ~chunked)
            | ((F.col("event_type") == "prediction_result") & (F.lower("current_status") == "completed"))
            | ((F.col("event_type") == "request_status") & (F.lower("current_status") == "completed"))
        ).alias("_finished"),
        F.max(F.when(moved, done_part)).alias("_part"),
        F.max(F.when(in_chunk, F.col("total_chunks"))).alias("_chunks"),
        F.max(F.when(single, best)).alias("_best"),
    )
    per_request = per_chunk.groupBy("request_id").agg(
        F.max("_seen").alias("_seen"),
        F.max("_started").alias("_started"),
        F.max("_finished").alias("_finished"),
        F.sum("_part").alias("_parts"),
        F.max("_chunks").alias("_chunks"),
        F.max("_best").alias("_best"),
    )
    shared = F.coalesce(F.when(F.col("_chunks") > 1, F.col("_parts") / F.col("_chunks") * 100), F.lit(0.0))
    alone = F.coalesce(F.col("_best.p") / F.col("_best.b") * 100, F.lit(0.0))
    share = F.when(shared > 0, shared).otherwise(alone)
    running = F.least(F.lit(99.0), F.col("_seen") * 25 + F.col("_started") * 25 + share * 0.5)
    return per_request.select(
        "request_id", F.when(F.col("_finished") == 1, F.lit(100.0)).otherwise(running).alias("percent")
    )


# --- serving views -----------------------------------------------------------------------------

# Full primary key of every serving view (partition key, then clustering columns).
VIEW_KEYS: dict[str, tuple[str, ...]] = {
    "request_status_by_id": ("request_id",),
    "requests_by_day": ("request_date", "created_at", "request_id"),
    "requests_by_status_window": ("status_bucket", "updated_at", "request_id"),
    "requests_by_user_window": ("username_bucket", "created_at", "request_id"),
    "requests_by_protein_window": ("protein_bucket", "created_at", "request_id"),
    "request_proteins_by_request": ("request_id", "protein_id"),
    "protein_requests_by_protein": ("protein_id", "created_at", "request_id"),
    "request_timeline_by_id": ("request_id", "event_ts", "event_type"),
    "latest_prediction_by_protein": ("protein_id",),
    "prediction_history_by_protein": ("protein_id", "predicted_at", "request_id"),
    "prediction_by_request": ("request_id",),
    "raw_protein_events": ("ingest_date", "shard_id", "event_ts", "request_id"),
    "failed_requests_by_time": ("failure_date", "status_code", "failed_at", "request_id"),
    "feature_snapshot_by_request": ("request_id",),
    "pipeline_metrics_by_window": ("metric_date", "metric_name", "window_start"),
    "cassandra_serving_stats_by_day": ("stat_date", "stat_name"),
}


def keyed_view(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """V-01: last write per full primary key of a serving view; ``order`` is newest first."""
    return keep_first(df, VIEW_KEYS[name], order)


def status_views(status_log: DataFrame, ts: str = "updated_at", seq: str = "seq") -> dict[str, DataFrame]:
    """V-01, ST-07: the request views over one append-only status log.

    Bucket views come from the latest row per request, so a request never stays in a stale bucket.
    """
    keys = S.bucket_keys(F.col("created_at"), F.col("current_status"), F.col("username"), F.col("protein_id"))
    latest = latest_requests(status_log, ts, seq).withColumns(keys)
    names = (
        "request_status_by_id", "requests_by_day", "requests_by_status_window",
        "requests_by_user_window", "requests_by_protein_window",
    )
    views = {name: latest for name in names}
    newest = [F.desc(ts), F.desc(seq)]
    stages = status_log.withColumn("event_ts", F.col(ts)).withColumn("event_type", F.lit("request_status"))
    views["request_timeline_by_id"] = keyed_view(stages, "request_timeline_by_id", newest)
    return views


def prediction_views(log: DataFrame, seq: str = "seq") -> dict[str, DataFrame]:
    """V-01, ST-06: latest per protein, history and by request, over one prediction log.

    Latest means newest ``predicted_at``, whatever the arrival order.
    """
    newest = [F.desc("predicted_at"), F.desc(seq)]
    return {
        name: keyed_view(log, name, newest)
        for name in ("latest_prediction_by_protein", "prediction_history_by_protein", "prediction_by_request")
    }


def raw_event_view(events: DataFrame, seq: str = "seq", shards: int = 32) -> DataFrame:
    """V-01: raw events keyed by their own date and shard."""
    keyed = events.withColumns(
        {
            "ingest_date": F.to_date("event_time"),
            "shard_id": S.shard(F.col("request_id"), shards),
            "event_ts": F.col("event_time"),
        }
    )
    return keyed_view(keyed, "raw_protein_events", [F.desc(seq)])


def failure_view(dead: DataFrame, seq: str = "seq") -> DataFrame:
    """V-01: failures by date and error code."""
    keyed = dead.withColumns({"failure_date": F.to_date("failed_at"), "status_code": F.col("error_code")})
    return keyed_view(keyed, "failed_requests_by_time", [F.desc(seq)])


def serving_stats(stats: DataFrame, ts: str = "updated_at", seq: str = "seq") -> DataFrame:
    """V-02: last value per (local day, statistic)."""
    dated = stats.withColumn("stat_date", S.local_day(F.col(ts)))
    return keyed_view(dated, "cassandra_serving_stats_by_day", [F.desc(ts), F.desc(seq)])


def metric_rows(points: DataFrame, ts: str = "ts", seq: str = "seq") -> DataFrame:
    """ST-18: metric rows floored to the minute, last value per (day, name, minute), UTC."""
    start = F.date_trunc("minute", ts)
    placed = points.withColumns(
        {
            "window_start": start,
            "window_end": start + F.expr("interval 1 minute"),
            "metric_date": F.to_date(start),
        }
    )
    return keyed_view(placed, "pipeline_metrics_by_window", [F.desc(ts), F.desc(seq)])


# --- request admission -------------------------------------------------------------------------

MAX_RECORDS = 400
MODELS = ("ensemble", "esm_mlp", "protcnn", "bilstm")


def check_requests(requests: DataFrame, records: DataFrame) -> DataFrame:
    """E-19: ``error_message`` per request, null when it is admitted.

    ``requests``: request_id, model, top_k, threshold. ``records``: request_id, position, id,
    sequence. The earliest broken record wins, then record counts, then the parameters. All group
    checks are partially aggregated minima and counts; nothing is collected per request.
    """
    clean = records.select(
        "request_id", "position", S.trimmed_id(F.col("id")).alias("_id"),
        S.normalize_sequence(F.col("sequence")).alias("_seq"),
    )
    firsts = clean.groupBy("request_id", F.lower("_id").alias("_key")).agg(F.min("position").alias("_first"))
    seen = clean.withColumn("_key", F.lower("_id")).join(firsts, ["request_id", "_key"])
    bad_sequence = S.sequence_error(F.col("_seq"), "api")
    message = (
        F.when(F.col("_id") == "", "Each FASTA record must include a protein ID.")
        .when(
            F.col("position") > F.col("_first"),
            F.concat(F.lit("Duplicate protein ID in FASTA records: "), F.col("_id")),
        )
        .when(bad_sequence.isNotNull(), F.concat(F.col("_id"), F.lit(": "), bad_sequence))
    )
    per_request = (
        seen.withColumn("_message", message)
        .groupBy("request_id")
        .agg(
            F.count("*").alias("_records"),
            F.min(F.when(F.col("_message").isNotNull(), F.struct("position", "_message"))).alias("_worst"),
        )
    )
    n = F.coalesce("_records", F.lit(0))
    model = F.coalesce(F.nullif(F.lower(F.trim("model")), F.lit("")), F.lit("ensemble"))
    error = F.coalesce(
        F.col("_worst._message"),
        F.when(n == 0, "At least one FASTA record is required."),
        F.when(n > MAX_RECORDS, f"A request can include at most {MAX_RECORDS} FASTA records."),
        F.when(~model.isin(*MODELS), "model must be one of: " + ", ".join(MODELS)),
        F.when(~F.col("top_k").between(1, 500), "top_k must be between 1 and 500"),
        F.when(~F.col("threshold").between(0, 1), "threshold must be between 0 and 1"),
    )
    joined = requests.join(per_request, "request_id", "left")
    return joined.select("request_id", n.alias("n_records"), error.alias("error_message"))
