"""Registered queries: counts, distributions, load-test results, request-log rates, scaling."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import agg, loadtest, scoring
from seqloom.plans.domain import big, r4, r6, stamp
from seqloom.plans.registry import query

FMT = "'%Y-%m-%d %H:%M:%S'"


@query(
    "a01_value_counts",
    """SELECT term, count(*) AS n, round(count(*) / (SELECT count(*) FROM annotations), 6) AS share
       FROM annotations GROUP BY term ORDER BY n DESC, term LIMIT 20""",
)
def _(d):
    return agg.value_counts(d.annotations, "term", 20).select("term", "n", r6("share").alias("share"))


@query(
    "a02_nunique",
    """SELECT aspect, count(DISTINCT protein_id) AS n_unique FROM annotations GROUP BY 1
       UNION ALL SELECT 'all', count(DISTINCT protein_id) FROM annotations""",
)
def _(d):
    per = agg.nunique(d.annotations, "protein_id", ["aspect"])
    return per.unionByName(agg.nunique(d.annotations, "protein_id").withColumn("aspect", F.lit("all")))


@query("a03_group_size", "SELECT protein_id, count(*) AS n FROM annotations GROUP BY 1")
def _(d):
    return agg.group_size(d.annotations, "protein_id")


DESCRIBE = ("mean", "std", "min", "max", "p25", "p50", "p75")


@query(
    "a04_describe",
    """SELECT count(*) AS count, round(avg(length(sequence)), 4) AS mean, round(stddev_samp(length(sequence)), 4) AS std,
              CAST(min(length(sequence)) AS DOUBLE) AS min, CAST(max(length(sequence)) AS DOUBLE) AS max,
              round(quantile_cont(length(sequence), 0.25), 4) AS p25, round(quantile_cont(length(sequence), 0.5), 4) AS p50,
              round(quantile_cont(length(sequence), 0.75), 4) AS p75 FROM proteins""",
)
def _(d):
    lengths = d.proteins.select(F.length("sequence").alias("n"))
    return agg.describe(lengths, "n").select("count", *[r4(c).alias(c) for c in DESCRIBE])


@query(
    "a05_histogram",
    """WITH v AS (SELECT CAST(length(sequence) AS DOUBLE) AS x FROM proteins), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
       c AS (SELECT CAST(least(floor((x - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin, count(*) AS n FROM v, b GROUP BY 1)
       SELECT CAST(i AS BIGINT) AS bin, coalesce(n, 0) AS n, round(lo + i * ((hi - lo) / 50), 4) AS low
       FROM (SELECT unnest(range(50)) AS i) CROSS JOIN b LEFT JOIN c ON c.bin = i""",
)
def _(d):
    rows = agg.histogram(d.proteins.select(F.length("sequence").alias("n_letters")), "n_letters", 50)
    return rows.select(big("bin").alias("bin"), "n", r4("low").alias("low"))


@query(
    "a06_histogram_edges",
    """WITH t AS (SELECT taxon, count(*) AS n FROM taxonomy GROUP BY 1), m AS (SELECT max(n) AS hi FROM t)
       SELECT CAST(b AS BIGINT) AS bin, count(t.n) AS n FROM (SELECT unnest(range(5)) AS b) LEFT JOIN t ON
         (SELECT CASE WHEN t.n >= 0 AND t.n < 5 THEN 0 WHEN t.n >= 5 AND t.n < 8 THEN 1 WHEN t.n >= 8 AND t.n < 10 THEN 2
                      WHEN t.n >= 10 AND t.n < 14 THEN 3 WHEN t.n >= 14 AND t.n <= (SELECT hi FROM m) THEN 4 END) = b GROUP BY 1""",
)
def _(d):
    counts = agg.group_size(d.taxonomy, "taxon")
    top = counts.agg(F.max("n")).scalar()
    rows = agg.histogram_edges(counts, "n", [0, 5, 8, 10, 14, top])
    return rows.select(big("bin").alias("bin"), "n")


@query(
    "a07_mode_by",
    """SELECT term, arg_min(aspect, (-n, aspect)) AS mode FROM (SELECT term, aspect, count(*) AS n FROM annotations GROUP BY 1, 2) GROUP BY 1""",
)
def _(d):
    return agg.mode_by(d.annotations, "term", "aspect")


@query("a08_first_by", "SELECT protein_id, arg_min(checksum, position) AS first FROM inbound GROUP BY 1")
def _(d):
    return agg.first_by(d.inbound, "protein_id", "checksum", "position")


@query("a09_sets_by", "SELECT DISTINCT protein_id, term AS member FROM annotations")
def _(d):
    return agg.sets_by(d.annotations, "protein_id", "term")


@query(
    "a10_mean_ia_by_aspect",
    """SELECT a.aspect, round(avg(i.ia), 6) AS mean_ia, count(i.ia) AS n_rows FROM annotations a LEFT JOIN ia i ON i.term = a.term GROUP BY 1""",
)
def _(d):
    return agg.mean_ia_by_aspect(d.annotations, d.ia).select("aspect", r6("mean_ia").alias("mean_ia"), "n_rows")


@query(
    "a11_median_of",
    """SELECT l_returnflag AS flag, round(median(l_quantity), 6) AS median FROM lineitem GROUP BY 1""",
)
def _(d):
    rows = d.table("lineitem").select(F.col("l_returnflag").alias("flag"), "l_quantity")
    return agg.median_of(rows, "l_quantity", ["flag"]).select("flag", r6("median").alias("median"))


@query(
    "a12_letter_counts",
    "SELECT letter, count(*) AS n FROM (SELECT unnest(string_split(sequence, '')) AS letter FROM proteins WHERE sequence <> '') GROUP BY 1",
)
def _(d):
    return agg.letter_counts(d.proteins)


@query(
    "a13_long_tail",
    """SELECT term, n, row_number() OVER (ORDER BY n DESC, term) AS rank, round(log10(n + 1), 6) AS log_count
       FROM (SELECT term, count(*) AS n FROM annotations GROUP BY 1)""",
)
def _(d):
    return agg.long_tail(d.annotations, "term").select("term", "n", "rank", r6("log_count").alias("log_count"))


# --- evaluator tables --------------------------------------------------------------------------


@query(
    "a31_best_by_metric",
    """SELECT result_set, method, namespace, round(arg_min(f_w, (-f_w, tie, position, s)), 6) AS f_w,
              round(arg_min(threshold, (-f_w, tie, position, s)), 6) AS threshold FROM evaluations GROUP BY 1, 2, 3""",
)
def _(d):
    placed = d.evaluations.withColumn("place", F.struct("tie", "position", "s"))
    rows = agg.best_by_metric(placed, "f_w", ["result_set", "method", "namespace"], "place")
    return rows.select("result_set", "method", "namespace", r6("f_w").alias("f_w"), r6("threshold").alias("threshold"))


@query(
    "a31_best_by_lowest",
    """SELECT result_set, method, namespace, round(min(s), 6) AS s FROM evaluations GROUP BY 1, 2, 3""",
)
def _(d):
    placed = d.evaluations.withColumn("place", F.struct("tie", "position"))
    rows = agg.best_by_metric(placed, "s", ["result_set", "method", "namespace"], "place", higher=False)
    return rows.select("result_set", "method", "namespace", r6("s").alias("s"))


@query(
    "a32_metric_pivot",
    "SELECT method, "
    + ", ".join(f"round(max(s) FILTER (WHERE namespace = '{n}'), 6) AS {n}" for n in ("MF", "BP", "CC"))
    + " FROM evaluations GROUP BY 1",
)
def _(d):
    rows = agg.metric_pivot(d.evaluations, "s", ["MF", "BP", "CC"])
    return rows.select("method", *[r6(c).alias(c) for c in ("MF", "BP", "CC")])


@query(
    "a33_overall_score",
    """SELECT method, round(avg(m), 6) AS overall_mean FROM (SELECT method, namespace, min(s) AS m FROM evaluations GROUP BY 1, 2) GROUP BY 1""",
)
def _(d):
    best = d.evaluations.groupBy("method", "namespace").agg(F.min("s").alias("s"))
    return agg.overall_score(best, "s").select("method", r6("overall_mean").alias("overall_mean"))


@query(
    "a34_melt",
    """SELECT position, tie, 'f' AS metric, round(f, 6) AS value FROM evaluations
       UNION ALL SELECT position, tie, 'f_w', round(f_w, 6) FROM evaluations""",
)
def _(d):
    rows = agg.melt(d.evaluations.select("position", "tie", "f", "f_w"), ["position", "tie"], ["f", "f_w"])
    return rows.select("position", "tie", "metric", r6("value").alias("value"))


@query(
    "a42_score_histogram",
    """WITH v AS (SELECT l_returnflag AS split, l_extendedprice AS x FROM lineitem), b AS (SELECT min(x) AS lo, max(x) AS hi FROM v),
       c AS (SELECT split, CAST(least(floor((x - lo) / ((hi - lo) / 80)), 79) AS INT) AS bin, count(*) AS n FROM v, b GROUP BY 1, 2)
       SELECT s.split, CAST(i AS BIGINT) AS bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT split FROM v) s
       CROSS JOIN (SELECT unnest(range(80)) AS i) LEFT JOIN c ON c.bin = i AND c.split = s.split""",
)
def _(d):
    rows = d.table("lineitem").select(F.col("l_returnflag").alias("split"), "l_extendedprice")
    return agg.histogram(rows, "l_extendedprice", 80, ["split"]).select("split", big("bin").alias("bin"), "n")


# --- load tests --------------------------------------------------------------------------------


def _rank_sql(ratio: float, name: str) -> str:
    return f"max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * {ratio}, 0) AS BIGINT)) AS {name}"


@query(
    "a27_bench_summary",
    f"""WITH v AS (SELECT *, row_number() OVER (ORDER BY latency_ms) - 1 AS i, count(*) OVER () AS n FROM load_results)
        SELECT count(*) AS completed_requests, CAST(sum(record_count) AS BIGINT) AS completed_sequences,
          round(count(*) / 120.0, 4) AS throughput_rps, round(sum(record_count) / 120.0, 4) AS throughput_seq_per_sec,
          count(error) AS failure_count, round(count(error) / count(*), 6) AS failure_rate, round(avg(latency_ms), 4) AS latency_avg,
          min(latency_ms) AS latency_min, {_rank_sql(0.5, "latency_p50")}, {_rank_sql(0.95, "latency_p95")}, {_rank_sql(0.99, "latency_p99")},
          max(latency_ms) AS latency_max,
          'completed=' || count(*) FILTER (WHERE status = 'completed') || ',failed=' || count(*) FILTER (WHERE status = 'failed') AS statuses,
          (SELECT string_agg(request_label, ',' ORDER BY seq) FROM (SELECT * FROM load_results WHERE error IS NOT NULL ORDER BY seq LIMIT 5)) AS examples
        FROM v""",
)
def _(d):
    row = loadtest.bench_summary(d.load_results, 10**6, 10**7, 120.0)
    pairs = F.transform(F.map_entries("status_counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    labels = F.transform("failed_examples", lambda e: e["request_label"])
    return row.select(
        "completed_requests", big("completed_sequences").alias("completed_sequences"),
        r4("throughput_rps").alias("throughput_rps"), r4("throughput_seq_per_sec").alias("throughput_seq_per_sec"),
        "failure_count", r6("failure_rate").alias("failure_rate"), r4("latency_avg").alias("latency_avg"),
        big("latency_min").alias("latency_min"), "latency_p50", "latency_p95", "latency_p99", big("latency_max").alias("latency_max"),
        F.array_join(pairs, ",").alias("statuses"), F.array_join(labels, ",").alias("examples"),
    )


@query(
    "a28_bench_checkpoints",
    """WITH r AS (SELECT *, count(*) OVER w AS done, sum(record_count) OVER w AS seqs, count(error) OVER w AS bad FROM load_results
                  WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING))
       SELECT done AS completed_requests, CAST(seqs AS BIGINT) AS completed_sequences, round(done / elapsed_seconds, 4) AS throughput_rps,
              round(seqs / elapsed_seconds, 4) AS throughput_seq_per_sec, bad AS failure_count, round(bad / done, 6) AS failure_rate
       FROM r WHERE done % 250 = 0""",
)
def _(d):
    rows = loadtest.bench_checkpoints(d.load_results, 250)
    return rows.select(
        big("completed_requests").alias("completed_requests"), big("completed_sequences").alias("completed_sequences"),
        r4("throughput_rps").alias("throughput_rps"), r4("throughput_seq_per_sec").alias("throughput_seq_per_sec"),
        big("failure_count").alias("failure_count"), r6("failure_rate").alias("failure_rate"),
    )


@query(
    "a29_sampled_latency",
    """WITH s AS (SELECT latency_ms FROM load_results WHERE latency_ms IS NOT NULL ORDER BY sha256('42:' || seq), latency_ms LIMIT 2000),
       v AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) - 1 AS i, count(*) OVER () AS n FROM s)
       SELECT max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * 0.5, 0) AS BIGINT)) AS p50_est,
              max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)) AS p95_est,
              max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * 0.99, 0) AS BIGINT)) AS p99_est,
              (SELECT count(latency_ms) FROM load_results) AS seen FROM v""",
)
def _(d):
    # smaller than the default, so that the given tables are sampled and not taken whole
    return loadtest.sampled_latency(d.load_results, "seq", size=2000)


@query("a29_approx_latency")
def _(d):
    return loadtest.approx_latency(d.load_results)


@query(
    "a30_scale_table",
    """SELECT record_count * 1000 AS requests, round(count(*) / 120.0, 2) AS throughput_rps, round(count(error) / count(*) * 100, 4) AS failure_rate_pct,
              round(CAST(max(latency_ms) AS DOUBLE), 2) AS p95_ms, round(CAST(min(latency_ms) AS DOUBLE), 2) AS p99_ms FROM load_results GROUP BY record_count""",
)
def _(d):
    failed = F.count("error").cast("double")
    summaries = d.load_results.groupBy("record_count").agg(
        (F.count("*") / 120.0).alias("throughput_rps"), (failed / F.count("*")).alias("failure_rate"),
        F.max("latency_ms").alias("latency_p95"), F.min("latency_ms").alias("latency_p99"),
    )
    return loadtest.scale_table(summaries.withColumn("planned_total_requests", F.col("record_count") * 1000))


# --- request log -------------------------------------------------------------------------------


@query(
    "a39_rate_by_path",
    f"""SELECT path, strftime(w, {FMT}) AS window_start, round(count(*) / 300.0, 6) AS rate FROM request_log,
          LATERAL (SELECT unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w)
        GROUP BY path, w""",
)
def _(d):
    rows = loadtest.rate_by_path(d.request_log)
    return rows.select("path", stamp("window_start").alias("window_start"), r6("rate").alias("rate"))


@query(
    "a40_error_ratio",
    f"""SELECT strftime(w, {FMT}) AS window_start,
               round((count(*) FILTER (WHERE status >= 500) / 300.0) / greatest(count(*) / 300.0, 0.001), 6) AS error_ratio FROM request_log,
          LATERAL (SELECT unnest(generate_series(date_trunc('minute', ts) - INTERVAL 4 MINUTE, date_trunc('minute', ts), INTERVAL 1 MINUTE)) AS w)
        GROUP BY w""",
)
def _(d):
    rows = loadtest.error_ratio(d.request_log)
    return rows.select(stamp("window_start").alias("window_start"), r6("error_ratio").alias("error_ratio"))


_BOUNDS = loadtest.LATENCY_BUCKETS


@query(
    "a41_bucket_quantile",
    f"""WITH b AS (SELECT unnest({list(_BOUNDS)}::DOUBLE[]) AS hi), p AS (SELECT path, count(*) AS n FROM request_log GROUP BY 1),
        c AS (SELECT p.path, p.n, b.hi, coalesce(lag(b.hi) OVER (PARTITION BY p.path ORDER BY b.hi), 0) AS lo,
                (SELECT count(*) FROM request_log r WHERE r.path = p.path AND r.duration_s <= b.hi) AS upto FROM p, b),
        e AS (SELECT *, coalesce(lag(upto) OVER (PARTITION BY path ORDER BY hi), 0) AS before FROM c)
        SELECT path, round(coalesce(arg_min(lo + (hi - lo) * (0.95 * n - before) / (upto - before), hi) FILTER (WHERE upto >= 0.95 * n), 60.0), 6) AS quantile
        FROM e GROUP BY path""",
)
def _(d):
    return loadtest.bucket_quantile(d.request_log).select("path", r6("quantile").alias("quantile"))


# --- scaling and chunks ------------------------------------------------------------------------


@query(
    "x01_scale_up",
    """WITH b AS (SELECT protein_id, row_number() OVER (ORDER BY protein_id) - 1 AS i, count(*) OVER () AS n FROM proteins)
       SELECT CAST(s AS BIGINT) AS sequence_index, CASE WHEN s // n = 0 THEN CAST(protein_id AS VARCHAR) ELSE protein_id || '__r' || (s // n + 1) END AS protein_id
       FROM (SELECT unnest(range((SELECT count(*) * 5 // 2 FROM proteins))) AS s) JOIN b ON b.i = s % (SELECT count(*) FROM proteins)""",
)
def _(d):
    base = d.table("documents").select(F.col("doc_id").cast("string").alias("protein_id"), "doc_id")
    n = F.floor(base.agg(F.count("*")).scalar() * 5 / 2)
    return loadtest.scale_up(base, n, ["doc_id"]).select("sequence_index", "protein_id")


@query(
    "x02_to_requests",
    """SELECT (event_id // 10) + 1 AS request_index, count(*) AS record_count, string_agg('u' || user_id, ',' ORDER BY event_id) AS ids
       FROM events GROUP BY 1""",
)
def _(d):
    rows = d.table("events").select(F.col("event_id").alias("sequence_index"), F.concat(F.lit("u"), "user_id").alias("protein_id"))
    out = loadtest.to_requests(rows, 10)
    return out.select("request_index", "record_count", F.array_join("protein_ids", ",").alias("ids"))


@query(
    "w08_chunk",
    """WITH x AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i FROM events)
       SELECT event_type, event_id, i // 64 AS chunk_index, i % 64 AS chunk_position,
              count(*) OVER (PARTITION BY event_type, i // 64) AS chunk_size, max(i // 64) OVER (PARTITION BY event_type) + 1 AS total_chunks FROM x""",
)
def _(d):
    rows = scoring.chunk(d.table("events").select("event_type", "event_id"), 64, ["event_id"], ["event_type"])
    return scoring.with_chunk_totals(rows, ["event_type"])


