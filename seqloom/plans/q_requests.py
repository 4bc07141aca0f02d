"""Registered queries: filters, dedupe, windows, dashboards and serving views."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from seqloom.operators import dedupe, joins, requests
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import keep_first
from seqloom.plans.domain import big, r4, r6, stamp
from seqloom.plans.registry import query
from seqloom.sources import tables

DAY = date(2024, 1, 15)
NOW = datetime(2024, 1, 15, 9, 30)
# the local day 2024-01-15 at +07:00, in UTC
IN_DAY = "created_at >= TIMESTAMP '2024-01-14 17:00:00' AND created_at < TIMESTAMP '2024-01-15 17:00:00'"
DAY_LOG = f"day_log AS (SELECT * FROM status_log WHERE {IN_DAY})"
DAY_LATEST = f"""{DAY_LOG}, day_latest AS (SELECT * FROM day_log
    QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, seq DESC) = 1)"""
FMT = "'%Y-%m-%d %H:%M:%S'"
SHOWN = ["request_id", "username", "current_status"]


@query("f01_visible_to", "SELECT seq, request_id, username FROM status_log WHERE username = 'u7'")
def _(d):
    return requests.visible_to(d.status_log, "u7").select("seq", "request_id", "username")


@query(
    "f02_list_requests",
    f"""SELECT request_id, username, current_status, strftime(updated_at, {FMT}) AS updated_at FROM latest_log
        WHERE {IN_DAY} AND current_status = 'failed' ORDER BY latest_log.updated_at DESC, request_id LIMIT 50""",
)
def _(d):
    latest = dedupe.latest_requests(d.status_log)
    return requests.list_requests(latest, DAY, status="FAILED", limit=50).select(*SHOWN, stamp("updated_at").alias("updated_at"))


@query(
    "f03_last_days",
    """SELECT seq, request_id FROM status_log
       WHERE created_at >= TIMESTAMP '2024-01-08 17:00:00' AND created_at < TIMESTAMP '2024-01-15 17:00:00'""",
)
def _(d):
    return requests.last_days(d.status_log, 7, DAY).select("seq", "request_id")


@query(
    "f05_to_request",
    f"""SELECT request_id, protein_id, username, source, strftime(created_at, {FMT}) AS created_at, current_status, stage_name,
               error_code, CAST(coalesce(retry_count, 0) AS BIGINT) AS retry_count FROM status_log""",
)
def _(d):
    upper = d.status_log.withColumn("current_status", F.upper("current_status"))
    rows = requests.to_request(upper)
    return rows.select(
        "request_id", "protein_id", "username", "source", stamp("created_at").alias("created_at"), "current_status",
        "stage_name", "error_code", big("retry_count").alias("retry_count"),
    )


@query(
    "f06_to_status_event",
    """SELECT request_id, CASE WHEN seq % 2 = 0 THEN 'override' ELSE current_status END AS status,
              stage_name AS stage, CAST(seq AS VARCHAR) AS seq FROM status_log""",
)
def _(d):
    extra = F.when(F.col("seq") % 2 == 0, F.create_map(F.lit("current_status"), F.lit("override")))
    out = requests.to_status_event(d.status_log, extra)
    get = lambda k: F.col("event")[k]
    return out.select("request_id", get("current_status").alias("status"), get("stage_name").alias("stage"), get("seq").alias("seq"))


@query(
    "f07_request_predictions",
    f"""SELECT protein_id, strftime(predicted_at, {FMT}) AS predicted_at, max_score FROM predictions WHERE request_id = 'r100'""",
)
def _(d):
    labelled = d.predictions.unionByName(
        d.predictions.withColumn("protein_id", F.lit("Batch:4-proteins"))
    )
    rows = requests.request_predictions(labelled, "r100")
    return rows.select("protein_id", stamp("predicted_at").alias("predicted_at"), "max_score")


@query(
    "f08_latest_visible",
    f"""SELECT request_id, protein_id, strftime(predicted_at, {FMT}) AS predicted_at, max_score FROM predictions
        WHERE lower(protein_id) = 'p7' AND request_id IN (SELECT request_id FROM latest_log WHERE username = 'u7')
        ORDER BY predictions.predicted_at DESC, request_id LIMIT 1""",
)
def _(d):
    latest = dedupe.latest_requests(d.status_log)
    row = requests.latest_visible(d.predictions, latest, "P7", "u7")
    return row.select("request_id", "protein_id", stamp("predicted_at").alias("predicted_at"), "max_score")


# --- dedupe ------------------------------------------------------------------------------------


KEPT = """WITH RECURSIVE e AS (SELECT request_id AS rq, protein_id || '/' || checksum AS ck, min(position) AS o FROM inbound GROUP BY 1, 2),
    step AS (
      SELECT rq, ck, o, FALSE AS kept FROM e
      UNION ALL
      SELECT rq, ck, o, sure FROM (
        SELECT *, bool_or(sure) OVER (PARTITION BY rq) OR bool_or(sure) OVER (PARTITION BY ck) AS touched FROM (
          SELECT rq, ck, o, o = min(o) OVER (PARTITION BY rq) AND o = min(o) OVER (PARTITION BY ck) AS sure FROM step WHERE NOT kept))
      WHERE sure OR NOT touched)"""


@query(
    "d01_dedupe_events",
    f"""{KEPT} SELECT position, request_id, protein_id, checksum FROM inbound WHERE position IN (SELECT o FROM step WHERE kept)""",
)
def _(d):
    return dedupe.dedupe_events(d.inbound, ["position"]).select("position", "request_id", "protein_id", "checksum")


@query(
    "d02_mark_duplicates",
    f"""{KEPT} SELECT request_id, protein_id, 'SKIPPED' AS current_status, 'spark_dedup' AS stage_name, 'DUPLICATE_EVENT' AS error_code,
               'Duplicate request_id or protein checksum in micro-batch.' AS error_message
        FROM inbound WHERE position NOT IN (SELECT o FROM step WHERE kept)""",
)
def _(d):
    return dedupe.mark_duplicates(d.inbound, ["position"])


@query("d03_distinct_pairs", "SELECT DISTINCT protein_id, term FROM annotations")
def _(d):
    return dedupe.distinct_pairs(d.annotations)


@query(
    "d04_merge_events",
    """WITH e AS (SELECT 'r' || (event_id // 16) AS request_id, event_type, date_trunc('hour', ts) AS event_ts,
              CASE WHEN event_id % 2 = 0 THEN 'batch' END AS modal_event, CASE WHEN event_id % 3 = 0 THEN 'score' END AS modal_step,
              event_id AS seq, event_id % 2 AS side FROM events),
       u AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY request_id, event_type, event_ts, coalesce(modal_event, ''),
              coalesce(modal_step, '') ORDER BY side DESC, seq DESC) = 1)
       SELECT request_id, event_type, seq FROM u
       QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY event_ts DESC, side DESC, seq DESC) <= 5""",
)
def _(d):
    e = d.table("events").select(
        F.concat(F.lit("r"), F.floor(F.col("event_id") / 16)).alias("request_id"), "event_type",
        F.date_trunc("hour", "ts").alias("event_ts"),
        F.when(F.col("event_id") % 2 == 0, "batch").alias("modal_event"),
        F.when(F.col("event_id") % 3 == 0, "score").alias("modal_step"),
        F.col("event_id").alias("seq"),
    )
    stored, live = e.filter("seq % 2 = 0"), e.filter("seq % 2 = 1")
    return dedupe.merge_events(stored, live, 5).select("request_id", "event_type", "seq")


@query(
    "d05_latest_requests",
    f"SELECT request_id, username, current_status, strftime(updated_at, {FMT}) AS updated_at, seq FROM latest_log",
)
def _(d):
    return dedupe.latest_requests(d.status_log).select(*SHOWN, stamp("updated_at").alias("updated_at"), "seq")


@query(
    "d06_last_by_id",
    """SELECT protein_id, checksum, position FROM inbound
       QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY position DESC) = 1""",
)
def _(d):
    return dedupe.last_by_id(d.inbound).select("protein_id", "checksum", "position")


@query(
    "d07_first_by_protein",
    """SELECT request_id, protein_id, max_score FROM predictions
       QUALIFY row_number() OVER (PARTITION BY request_id, lower(protein_id) ORDER BY predicted_at, seq) = 1""",
)
def _(d):
    rows = dedupe.first_by_protein(d.predictions, [F.asc("predicted_at"), F.asc("seq")])
    return rows.select("request_id", "protein_id", "max_score")


@query(
    "d08_latest_by_request_protein",
    """SELECT request_id, protein_id, max_score FROM predictions
       QUALIFY row_number() OVER (PARTITION BY request_id, lower(protein_id) ORDER BY predicted_at DESC, seq DESC) = 1""",
)
def _(d):
    rows = dedupe.latest_prediction_by_request_protein(d.predictions, [F.desc("predicted_at"), F.desc("seq")])
    return rows.select("request_id", "protein_id", "max_score")


# --- windows and pages -------------------------------------------------------------------------


@query(
    "w03_page",
    f"""WITH o AS (SELECT *, row_number() OVER (ORDER BY updated_at DESC, request_id) AS rn FROM latest_log)
        SELECT request_id, current_status, (SELECT count(*) FROM o) > 60 AS has_next FROM o WHERE rn > 40 AND rn <= 60""",
)
def _(d):
    latest = dedupe.latest_requests(d.status_log)
    rows = requests.page(latest, 3, 20, [F.desc("updated_at"), F.asc("request_id")])
    return rows.select("request_id", "current_status", "has_next")


@query(
    "w03_seek_pages",
    f"""WITH o AS (SELECT *, row_number() OVER (ORDER BY updated_at DESC, request_id) AS rn, count(*) OVER () AS n FROM latest_log)
        SELECT request_id, current_status, (rn - 1) // 25 + 1 AS page, (rn - 1) // 25 * 25 + 25 < n AS has_next FROM o WHERE rn <= 75""",
)
def _(d):
    # three pages, each from the last row of the one before
    latest = cut_lineage(dedupe.latest_requests(d.status_log))
    order, last, pages = [("updated_at", True), ("request_id", False)], None, []
    for number in (1, 2, 3):
        rows = cut_lineage(requests.page_after(latest, 25, order, last))
        pages.append(rows.select("request_id", "current_status", F.lit(number).cast("bigint").alias("page"), "has_next"))
        end = rows.orderBy(F.asc("updated_at"), F.desc("request_id")).first()
        if end is None or not end.has_next:
            break
        last = (end.updated_at, end.request_id)
    return joins.union_all(pages)


@query(
    "w04_latest_n",
    """SELECT lower(protein_id) AS protein, request_id, max_score FROM predictions
       QUALIFY row_number() OVER (PARTITION BY lower(protein_id) ORDER BY predicted_at DESC, request_id) <= 5""",
)
def _(d):
    rows = d.predictions.withColumn("protein", F.lower("protein_id"))
    return requests.latest_n(rows, ["protein"], 5, "predicted_at").select("protein", "request_id", "max_score")


@query(
    "w05_timeline",
    f"""SELECT event_type, strftime(ts, {FMT}) AS event_ts FROM
        (SELECT 'r' || (event_id // 400) AS request_id, event_type, ts FROM events) WHERE request_id = 'r3'
        ORDER BY ts DESC, event_type DESC LIMIT 80""",
)
def _(d):
    rows = d.table("events").select(
        F.concat(F.lit("r"), F.floor(F.col("event_id") / 400)).alias("request_id"), "event_type", F.col("ts").alias("event_ts")
    )
    return requests.timeline(rows, "r3", 80).select("event_type", stamp("event_ts").alias("event_ts"))


@query(
    "w06_recent",
    """SELECT 'request' AS kind, request_id FROM (SELECT * FROM latest_log ORDER BY updated_at DESC, request_id LIMIT 10)
       UNION ALL SELECT 'failure', request_id FROM (SELECT * FROM latest_log WHERE current_status = 'failed' ORDER BY updated_at DESC, request_id LIMIT 10)
       UNION ALL SELECT 'prediction', request_id FROM (SELECT * FROM predictions ORDER BY predicted_at DESC, request_id LIMIT 10)""",
)
def _(d):
    latest = dedupe.latest_requests(d.status_log)
    kinds = {
        "request": requests.recent(latest),
        "failure": requests.recent(latest.filter("current_status = 'failed'")),
        "prediction": requests.recent(d.predictions, ts="predicted_at"),
    }
    out = None
    for kind, rows in kinds.items():
        part = rows.select(F.lit(kind).alias("kind"), "request_id")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "w09_metric_points",
    f"""SELECT strftime(date_trunc('minute', ts), {FMT}) AS window_start, round(arg_max(value, (ts, event_id)), 6) AS metric_value
        FROM events WHERE event_type = 'view' GROUP BY date_trunc('minute', ts) ORDER BY date_trunc('minute', ts) DESC LIMIT 30""",
)
def _(d):
    points = d.table("events").select(
        F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"), "ts", F.col("event_id").alias("seq")
    )
    rows = requests.metric_points(requests.metric_rows(points), "view", 30)
    return rows.select(stamp("window_start").alias("window_start"), r6("metric_value").alias("metric_value"))


# --- dashboard aggregates ----------------------------------------------------------------------


@query(
    "a16_status_counts",
    """SELECT s AS current_status, CAST(count(l.request_id) AS BIGINT) AS n
       FROM (SELECT unnest(['pending','processing','completed','failed','retrying','cancelled']) AS s) k
       LEFT JOIN latest_log l ON l.current_status = k.s GROUP BY s""",
)
def _(d):
    return requests.status_counts(dedupe.latest_requests(d.status_log))


@query(
    "a17_error_counts",
    """SELECT coalesce(error_code, 'UNKNOWN') AS error_code, count(*) AS n FROM latest_log
       WHERE current_status = 'failed' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 8""",
)
def _(d):
    return requests.error_counts(dedupe.latest_requests(d.status_log))


@query(
    "a18_error_rate",
    "SELECT round_even(avg(CASE WHEN current_status = 'failed' THEN 1.0 ELSE 0.0 END), 4) AS error_rate FROM latest_log",
)
def _(d):
    return requests.error_rate(dedupe.latest_requests(d.status_log))


def _latency_sql(where: str) -> str:
    return f"""WITH v AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) - 1 AS i, count(*) OVER () AS n
        FROM status_log WHERE {where})
        SELECT CAST(round_even(avg(latency_ms), 0) AS BIGINT) AS avg_latency_ms,
               max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)) AS p95_latency_ms FROM v"""


@query("a19_latency_stats", _latency_sql("latency_ms > 0"))
def _(d):
    return requests.latency_stats(d.status_log)


@query("a19_latency_stats_all", _latency_sql("latency_ms IS NOT NULL"))
def _(d):
    return requests.latency_stats(d.status_log, positive_only=False)


@query(
    "a20_request_latency",
    "SELECT request_id, max(latency_ms) AS latency_ms FROM status_log WHERE latency_ms > 0 GROUP BY 1",
)
def _(d):
    return requests.request_latency(d.status_log)


THROUGHPUT_SQL = f"""SELECT strftime(m, {FMT}) AS window_start, strftime(m + INTERVAL 1 MINUTE, {FMT}) AS window_end,
    'events_per_minute' AS metric_name, count(l.request_id) AS metric_value
    FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 09:23:00', TIMESTAMP '2024-01-15 09:30:00', INTERVAL 1 MINUTE)) AS m)
    LEFT JOIN status_log l ON date_trunc('minute', l.created_at) = m GROUP BY m"""


@query("a21_throughput", THROUGHPUT_SQL)
def _(d):
    rows = requests.throughput(d.status_log, NOW)
    return rows.select(stamp("window_start").alias("window_start"), stamp("window_end").alias("window_end"), "metric_name", "metric_value")


@query(
    "a22_batch_metrics",
    """SELECT count(*) AS input_events, count(*) FILTER (WHERE error_message IS NULL) AS valid_events,
         count(*) FILTER (WHERE error_message IS NULL AND position % 10 = 1) AS duplicate_events,
         count(*) FILTER (WHERE error_message IS NULL AND position % 10 > 2) AS predictions,
         count(*) FILTER (WHERE error_message IS NULL AND position % 10 = 2) AS failures,
         CAST(max(position % 977) AS BIGINT) AS latency_ms
       FROM (SELECT * REPLACE (CASE WHEN position % 10 = 0 THEN 'x' ELSE error_message END AS error_message) FROM parsed)""",
)
def _(d):
    from seqloom.functions.validate import read_messages

    ten = F.col("position") % 10
    ok = F.col("error_message").isNull() & (ten != 0)
    flagged = read_messages(d.messages).select(
        F.lit(True).alias("arrived"), ok.alias("valid"), (ok & (ten != 1)).alias("kept"), (ok & (ten > 2)).alias("scored"),
        (ok & (ten == 2)).alias("failed"), (F.col("position") % 977).alias("latency_ms"),
    )
    return requests.batch_metrics(flagged)


@query(
    "a23_write_amplification",
    """WITH k AS (SELECT CASE WHEN event_type IN ('click', 'purchase') THEN 'prediction_result'
                             WHEN event_type = 'error' THEN 'dead_letter' ELSE 'request_status' END AS kind FROM events),
       t AS (SELECT 'request_status' AS kind, unnest(['request_status_by_id','requests_by_day','requests_by_status_window',
               'requests_by_user_window','requests_by_protein_window','request_proteins_by_request','protein_requests_by_protein',
               'request_timeline_by_id']) AS table_name
             UNION ALL SELECT 'prediction_result', unnest(['latest_prediction_by_protein','prediction_history_by_protein',
               'request_proteins_by_request','protein_requests_by_protein','request_timeline_by_id']))
       SELECT table_name, count(*) AS writes FROM k JOIN t USING (kind) GROUP BY 1""",
)
def _(d):
    kind = (
        F.when(F.col("event_type").isin("click", "purchase"), "prediction_result")
        .when(F.col("event_type") == "error", "dead_letter")
        .otherwise("request_status")
    )
    return requests.write_amplification(d.table("events").select(kind.alias("event_type")))


@query(
    "a24_total_today",
    """SELECT count(*) AS total_today FROM latest_log
       WHERE updated_at >= TIMESTAMP '2024-01-14 17:00:00' AND updated_at < TIMESTAMP '2024-01-15 17:00:00'""",
)
def _(d):
    return requests.total_today(dedupe.latest_requests(d.status_log), DAY)


@query(
    "a25_dashboard_counts",
    """SELECT (SELECT CAST(sum(coalesce(n, 1)) AS BIGINT) FROM orders o LEFT JOIN
               (SELECT request_id, count(*) AS n FROM request_records GROUP BY 1) r ON r.request_id = o.o_orderkey) AS protein_count,
              (SELECT count(DISTINCT (p.request_id, p.protein_id)) FROM request_records p
               WHERE p.position > 3 AND p.request_id IN (SELECT o_orderkey FROM orders)) AS prediction_count""",
)
def _(d):
    heads = d.table("orders").select(F.col("o_orderkey").alias("request_id"))
    return requests.dashboard_counts(heads, d.request_records, d.request_records.filter("position > 3"))


@query(
    "a26_dashboard_summary",
    f"""WITH {DAY_LATEST},
      lat AS (SELECT request_id, max(latency_ms) AS v FROM day_log WHERE latency_ms > 0 GROUP BY 1),
      ranked AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n FROM lat),
      minutes AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-15 09:23:00', TIMESTAMP '2024-01-15 09:30:00', INTERVAL 1 MINUTE)) AS m),
      predicted AS (SELECT request_id, protein_id, max(predicted_at) AS made FROM predictions
        WHERE predicted_at >= TIMESTAMP '2024-01-14 17:00:00' AND predicted_at < TIMESTAMP '2024-01-15 17:00:00' GROUP BY 1, 2),
      sizes AS (SELECT 'r' || request_id AS request_id, count(*) AS n FROM request_records GROUP BY 1),
      counts AS (SELECT (SELECT count(*) FROM day_latest WHERE updated_at >= TIMESTAMP '2024-01-14 17:00:00' AND updated_at < TIMESTAMP '2024-01-15 17:00:00') AS requests,
        (SELECT sum(coalesce(n, 1)) FROM day_latest LEFT JOIN sizes USING (request_id)) AS proteins,
        (SELECT count(*) FROM day_log) AS stages, (SELECT count(*) FROM predicted) AS predictions)
      SELECT 'total' AS section, 'protein_count' AS item, CAST(proteins AS DOUBLE) AS value FROM counts
      UNION ALL SELECT 'total', 'prediction_count', CAST(predictions AS DOUBLE) FROM counts
      UNION ALL SELECT 'writes', t, CAST(requests AS DOUBLE) FROM counts, (SELECT unnest(['request_status_by_id', 'requests_by_day',
        'requests_by_status_window', 'requests_by_user_window', 'requests_by_protein_window']) AS t)
      UNION ALL SELECT 'writes', t, CAST(proteins AS DOUBLE) FROM counts, (SELECT unnest(['request_proteins_by_request', 'protein_requests_by_protein']) AS t)
      UNION ALL SELECT 'writes', 'request_timeline_by_id', CAST(greatest(requests, stages) AS DOUBLE) FROM counts
      UNION ALL SELECT 'writes', t, CAST(predictions AS DOUBLE) FROM counts,
        (SELECT unnest(['latest_prediction_by_protein', 'prediction_history_by_protein', 'prediction_by_request']) AS t)
      UNION ALL SELECT * FROM (SELECT 'recent_prediction', request_id || ' ' || protein_id, CAST(floor(epoch(made)) AS DOUBLE) FROM predicted
        ORDER BY made DESC, request_id, protein_id LIMIT 10)
      UNION ALL SELECT 'status', s, CAST(count(l.request_id) AS DOUBLE)
        FROM (SELECT unnest(['pending','processing','completed','failed','retrying','cancelled']) AS s) k
        LEFT JOIN day_latest l ON l.current_status = k.s GROUP BY s
      UNION ALL SELECT * FROM (SELECT 'error', coalesce(error_code, 'UNKNOWN') AS c, CAST(count(*) AS DOUBLE) AS n
        FROM day_latest WHERE current_status = 'failed' GROUP BY c ORDER BY n DESC, c LIMIT 8)
      UNION ALL SELECT 'rate', 'error_rate', round_even(avg(CASE WHEN current_status = 'failed' THEN 1.0 ELSE 0.0 END), 4) FROM day_latest
      UNION ALL SELECT 'total', 'total_today', CAST(count(*) AS DOUBLE) FROM day_latest
        WHERE updated_at >= TIMESTAMP '2024-01-14 17:00:00' AND updated_at < TIMESTAMP '2024-01-15 17:00:00'
      UNION ALL SELECT 'latency', 'avg_latency_ms', CAST(round_even(avg(v), 0) AS DOUBLE) FROM lat
      UNION ALL SELECT 'latency', 'p95_latency_ms', CAST(max(v) FILTER (WHERE i = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)) AS DOUBLE) FROM ranked
      UNION ALL SELECT 'throughput', strftime(m, '%Y-%m-%d %H:%M'), CAST(count(l.request_id) AS DOUBLE)
        FROM minutes LEFT JOIN day_latest l ON date_trunc('minute', l.created_at) = m GROUP BY m
      UNION ALL SELECT * FROM (SELECT 'recent_request', request_id, CAST(floor(epoch(updated_at)) AS DOUBLE) FROM day_latest
        ORDER BY updated_at DESC, request_id LIMIT 10)
      UNION ALL SELECT * FROM (SELECT 'recent_failure', request_id, CAST(floor(epoch(updated_at)) AS DOUBLE) FROM day_latest
        WHERE current_status = 'failed' ORDER BY updated_at DESC, request_id LIMIT 10)""",
)
def _(d):
    links = d.request_records.select(F.concat(F.lit("r"), "request_id").alias("request_id"), "protein_id")
    return requests.dashboard_summary(d.status_log, d.predictions, links, "admin", True, DAY, NOW)


@query(
    "a38_request_progress",
    """WITH e AS (SELECT 'r' || (event_id // 8) AS request_id, event_id AS seq, event_id // 8 AS g, event_id % 8 AS i FROM events),
       x AS (SELECT *, CASE WHEN i = 0 THEN 'start' WHEN i < 7 THEN 'batch' WHEN g % 3 = 0 THEN 'done' ELSE 'progress' END AS kind,
               CASE WHEN g % 2 = 0 THEN 2 END AS total_chunks, CASE WHEN g % 2 = 0 AND i BETWEEN 1 AND 6 THEN i % 2 END AS chunk_index,
               CASE WHEN i BETWEEN 1 AND 6 THEN 4 END AS total_batches, CASE WHEN i BETWEEN 1 AND 6 THEN (i - 1) // 2 END AS batch_index FROM e),
       c AS (SELECT request_id, chunk_index, max(least(4, batch_index + 1) / 4) AS part FROM x WHERE kind = 'batch' AND chunk_index IS NOT NULL GROUP BY 1, 2),
       p AS (SELECT request_id, sum(part) AS parts FROM c GROUP BY 1),
       a AS (SELECT x.request_id, max(CASE WHEN kind IN ('start', 'batch') THEN 1 ELSE 0 END) AS seen, max(CASE WHEN kind = 'batch' THEN 1 ELSE 0 END) AS started,
               max(CASE WHEN kind = 'done' AND g % 2 = 1 THEN 1 ELSE 0 END) AS finished, max(total_chunks) AS chunks,
               max(CASE WHEN kind = 'batch' AND total_chunks IS NULL THEN (batch_index + 1) / 4 END) AS alone FROM x GROUP BY 1)
       SELECT a.request_id, round(CASE WHEN finished = 1 THEN 100.0 ELSE least(99.0, 25 * seen + 25 * started + 0.5 *
              CASE WHEN coalesce(parts / chunks * 100, 0) > 0 THEN parts / chunks * 100 ELSE coalesce(alone, 0) * 100 END) END, 6) AS percent
       FROM a LEFT JOIN p ON a.request_id = p.request_id""",
)
def _(d):
    g, i = F.floor(F.col("event_id") / 8), F.col("event_id") % 8
    mid = i.between(1, 6)
    kind = F.when(i == 0, "start").when(i < 7, "batch").when(g % 3 == 0, "done").otherwise("progress")
    null = F.lit(None).cast("string")
    rows = d.table("events").select(
        F.concat(F.lit("r"), g).alias("request_id"), F.col("event_id").alias("seq"), F.lit("request_status").alias("event_type"),
        kind.alias("modal_event"), F.lit("other").alias("modal_step"), null.alias("current_status"),
        F.when(g % 2 == 0, 2).alias("total_chunks"), F.when((g % 2 == 0) & mid, i % 2).alias("chunk_index"),
        F.when(mid, 4).alias("total_batches"), F.when(mid, F.floor((i - 1) / 2)).alias("batch_index"),
    )
    out = requests.request_progress(rows)
    return out.select("request_id", r6("percent").alias("percent"))


@query("a43_last_event_at", f"SELECT strftime(max(ts), {FMT}) AS last_event_at FROM events")
def _(d):
    return requests.last_event_at(d.table("events")).select(stamp("last_event_at").alias("last_event_at"))


# --- views, upserts, registry ------------------------------------------------------------------


@query(
    "v01_requests_by_status",
    """SELECT strftime(created_at + INTERVAL 7 HOUR, '%Y-%m-%d') || '#' || current_status AS status_bucket, request_id, seq FROM latest_log""",
)
def _(d):
    return requests.status_views(d.status_log)["requests_by_status_window"].select("status_bucket", "request_id", "seq")


@query(
    "v01_requests_by_user",
    """SELECT strftime(created_at + INTERVAL 7 HOUR, '%Y-%m-%d') || '#' || username AS username_bucket, request_id, seq FROM latest_log""",
)
def _(d):
    return requests.status_views(d.status_log)["requests_by_user_window"].select("username_bucket", "request_id", "seq")


@query(
    "v01_request_timeline",
    """SELECT request_id, stage_name, seq FROM status_log
       QUALIFY row_number() OVER (PARTITION BY request_id, updated_at ORDER BY seq DESC) = 1""",
)
def _(d):
    return requests.status_views(d.status_log)["request_timeline_by_id"].select("request_id", "stage_name", "seq")


@query(
    "v01_latest_prediction",
    """SELECT protein_id, request_id, max_score FROM predictions
       QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY predicted_at DESC, seq DESC) = 1""",
)
def _(d):
    return requests.prediction_views(d.predictions)["latest_prediction_by_protein"].select("protein_id", "request_id", "max_score")


@query(
    "v01_raw_events_by_shard",
    """SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, ('0x' || right(sha256(request_id), 8))::BIGINT % 32 AS shard_id,
              count(*) AS n FROM inbound GROUP BY 1, 2""",
)
def _(d):
    view = requests.raw_event_view(d.inbound.withColumnsRenamed({"ts": "event_time", "position": "seq"}))
    keys = [F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"), big("shard_id").alias("shard_id")]
    return view.groupBy(*keys).agg(F.count("*").alias("n"))


@query(
    "v01_failures_by_time",
    """SELECT strftime(updated_at, '%Y-%m-%d') AS failure_date, error_code AS status_code, request_id, seq FROM status_log
       WHERE current_status = 'failed'""",
)
def _(d):
    dead = d.status_log.filter("current_status = 'failed'").withColumnRenamed("updated_at", "failed_at")
    day = F.date_format("failure_date", "yyyy-MM-dd").alias("failure_date")
    return requests.failure_view(dead).select(day, "status_code", "request_id", "seq")


@query(
    "v02_serving_stats",
    """SELECT strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d') AS stat_date, event_type AS stat_name, round(value, 6) AS stat_value FROM events
       QUALIFY row_number() OVER (PARTITION BY strftime(ts + INTERVAL 7 HOUR, '%Y-%m-%d'), event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(d):
    stats = d.table("events").select(
        F.col("event_type").alias("stat_name"), F.col("ts").alias("updated_at"), "value", F.col("event_id").alias("seq")
    )
    rows = requests.serving_stats(stats)
    return rows.select(F.date_format("stat_date", "yyyy-MM-dd").alias("stat_date"), "stat_name", r6("value").alias("stat_value"))


@query(
    "st18_metric_rows",
    f"""SELECT strftime(date_trunc('minute', ts), {FMT}) AS window_start, event_type AS metric_name, round(value, 6) AS metric_value FROM events
        QUALIFY row_number() OVER (PARTITION BY date_trunc('minute', ts), event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(d):
    points = d.table("events").select(
        F.col("event_type").alias("metric_name"), F.col("value").alias("metric_value"), "ts", F.col("event_id").alias("seq")
    )
    rows = requests.metric_rows(points)
    return rows.select(stamp("window_start").alias("window_start"), "metric_name", r6("metric_value").alias("metric_value"))


@query(
    "snk07_upsert",
    """WITH u AS (SELECT *, CASE WHEN seq % 2 = 1 THEN 1 ELSE 0 END AS side FROM status_log)
       SELECT request_id, current_status, error_code, seq FROM u
       QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY side DESC, updated_at DESC, seq DESC) = 1""",
)
def _(d):
    old = keep_first(d.status_log.filter("seq % 2 = 0"), ["request_id"], [F.desc("updated_at"), F.desc("seq")])
    new = d.status_log.filter("seq % 2 = 1")
    out = tables.upsert(old, new, ["request_id"], ["updated_at", "seq"])
    return out.select("request_id", "current_status", "error_code", "seq")


@query(
    "snk08_upsert_keep",
    f"""WITH o AS (SELECT * FROM predictions WHERE seq % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY seq) = 1),
        n AS (SELECT * FROM predictions WHERE seq % 3 = 0 QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY seq) = 1)
        SELECT coalesce(o.request_id, n.request_id) AS request_id, strftime(coalesce(o.predicted_at, n.predicted_at), {FMT}) AS created_at,
               CASE WHEN n.request_id IS NOT NULL THEN n.max_score ELSE o.max_score END AS max_score
        FROM o FULL OUTER JOIN n ON o.request_id = n.request_id""",
)
def _(d):
    one = lambda df: keep_first(df, ["request_id"], [F.asc("seq")]).select(
        "request_id", F.col("predicted_at").alias("created_at"), "max_score"
    )
    out = tables.upsert_keep(one(d.predictions.filter("seq % 3 <> 0")), one(d.predictions.filter("seq % 3 = 0")), ["request_id"], ["created_at"])
    return out.select("request_id", stamp("created_at").alias("created_at"), "max_score")


@query("snk09_expire", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-05 09:30:00'")
def _(d):
    return tables.expire(d.table("events"), "ts", 10, NOW).select("event_id")


@query(
    "snk10_delete_request",
    """WITH latest AS (SELECT * FROM predictions QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY predicted_at DESC, seq DESC) = 1),
       gone AS (SELECT DISTINCT request_id FROM status_log WHERE username = 'u7')
       SELECT 'status' AS table_name, count(*) AS n FROM status_log WHERE request_id NOT IN (SELECT request_id FROM gone)
       UNION ALL SELECT 'history', count(*) FROM predictions WHERE request_id NOT IN (SELECT request_id FROM gone)
       UNION ALL SELECT 'latest', count(*) FROM latest WHERE request_id NOT IN (SELECT request_id FROM gone)""",
)
def _(d):
    views = {
        "status": d.status_log,
        "history": d.predictions,
        "latest": requests.prediction_views(d.predictions)["latest_prediction_by_protein"],
    }
    out = None
    for name, df in tables.delete_request(views, requests.visible_to(d.status_log, "u7")).items():
        part = df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n")).select("table_name", "n")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "snk12_audit_record",
    """SELECT username AS actor, 'retry' AS action, request_id AS target_id,
              sha256(username || '|retry|request|' || request_id || '|' || stage_name) AS audit_id
       FROM status_log WHERE current_status = 'failed'""",
)
def _(d):
    failed = d.status_log.filter("current_status = 'failed'")
    rows = tables.audit_record(failed, F.col("username"), "retry", "request", F.col("request_id"), F.col("stage_name"))
    return rows.select("actor", "action", "target_id", "audit_id")


@query(
    "r01_model_registry",
    f"""WITH o AS (SELECT model_version, min(ts) AS created_at, min(value) AS v FROM (SELECT 'm' || (user_id % 40) AS model_version, * FROM events WHERE event_id % 2 = 0) GROUP BY 1),
        n AS (SELECT model_version, min(ts) AS created_at, max(value) AS v FROM (SELECT 'm' || (user_id % 50) AS model_version, * FROM events WHERE event_id % 2 = 1) GROUP BY 1)
        SELECT coalesce(o.model_version, n.model_version) AS model_version, strftime(coalesce(o.created_at, n.created_at), {FMT}) AS created_at,
               round(CASE WHEN n.model_version IS NULL THEN o.v ELSE n.v END, 4) AS quality
        FROM o FULL OUTER JOIN n ON o.model_version = n.model_version""",
)
def _(d):
    e = d.table("events")
    side = lambda rest, n, pick: (
        e.filter(F.col("event_id") % 2 == rest)
        .groupBy(F.concat(F.lit("m"), F.col("user_id") % n).alias("model_version"))
        .agg(F.min("ts").alias("created_at"), pick("value").alias("quality"))
    )
    rows = tables.model_registry(side(0, 40, F.min), side(1, 50, F.max))
    return rows.select("model_version", stamp("created_at").alias("created_at"), r4("quality").alias("quality"))


@query(
    "r02_replay_campaigns",
    f"""WITH o AS (SELECT replay_id, min(ts) AS created_at, 'planned' AS status FROM (SELECT 'c' || (event_id // 100) AS replay_id, * FROM events) WHERE event_id % 3 = 0 GROUP BY 1),
        n AS (SELECT replay_id, max(ts) AS created_at, max(event_type) AS status FROM (SELECT 'c' || (event_id // 90) AS replay_id, * FROM events) WHERE event_id % 3 <> 0 GROUP BY 1)
        SELECT coalesce(o.replay_id, n.replay_id) AS replay_id, strftime(coalesce(o.created_at, n.created_at), {FMT}) AS created_at,
               CASE WHEN n.replay_id IS NULL THEN o.status ELSE n.status END AS status
        FROM o FULL OUTER JOIN n ON o.replay_id = n.replay_id""",
)
def _(d):
    e = d.table("events")
    name = lambda n: F.concat(F.lit("c"), F.floor(F.col("event_id") / n)).alias("replay_id")
    old = e.filter("event_id % 3 = 0").groupBy(name(100)).agg(F.min("ts").alias("created_at"), F.lit("planned").alias("status"))
    new = e.filter("event_id % 3 <> 0").groupBy(name(90)).agg(F.max("ts").alias("created_at"), F.max("event_type").alias("status"))
    rows = tables.replay_campaigns(old, new)
    return rows.select("replay_id", stamp("created_at").alias("created_at"), "status")


@query(
    "r03_audit_log",
    f"""SELECT CAST(event_id AS VARCHAR) AS audit_id, 'u' || user_id AS actor, strftime(ts, {FMT}) AS created_at
        FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 100""",
)
def _(d):
    rows = d.table("events").select(
        F.col("event_id").alias("audit_id"), F.concat(F.lit("u"), "user_id").alias("actor"),
        F.col("event_type").alias("target_type"), F.col("ts").alias("created_at"),
    )
    newest = tables.audit_log(rows, "error", 100)
    return newest.select(F.col("audit_id").cast("string").alias("audit_id"), "actor", stamp("created_at").alias("created_at"))


