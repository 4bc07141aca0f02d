"""Registered queries: streams, stream-side operators, readers and writers.

Readers and writers are checked by a round trip: Spark writes files from the given tables and the
reader under test reads them back.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.functions.validate import parse_events, request_parameters
from seqloom.operators import dedupe, prep, requests
from seqloom.operators.lineage import scratch_path
from seqloom.plans.domain import big, r6, stamp
from seqloom.plans.registry import query
from seqloom.sources import readers, tables, writers
from seqloom.streaming import events as E
from seqloom.streaming import pipeline as P
from seqloom.streaming.sinks import drain, stream_table

FMT = "'%Y-%m-%d %H:%M:%S'"


# --- readers -----------------------------------------------------------------------------------


def _fasta_text(rows, key, sequence):
    wrapped = F.regexp_replace(sequence, "(.{60})", "$1\n")
    return rows.select(F.concat(F.lit(">"), key, F.lit("\n"), F.lower(wrapped)).alias("value"))


@query(
    "src01_read_fasta",
    "SELECT 'A' || protein_id AS protein_id, 'desc ' || protein_id AS description, sequence FROM proteins",
)
def _(d):
    path = scratch_path(d.spark)
    pid = F.col("protein_id").cast("string")
    key = F.concat(F.lit("sp|A"), pid, F.lit("|NAME desc "), pid)
    _fasta_text(d.proteins, key, F.col("sequence")).write.text(path)
    rows = readers.read_fasta(d.spark, path, id_mode="accession")
    return rows.select("protein_id", "description", "sequence")


@query(
    "src02_read_terms",
    """SELECT CAST(protein_id AS VARCHAR) AS protein_id, CAST(term AS VARCHAR) AS term, aspect FROM annotations""",
)
def _(d):
    path = scratch_path(d.spark)
    d.annotations.write.csv(path, sep="\t")
    return readers.read_terms(d.spark, path)


@query("src02_read_taxonomy_and_ia", """SELECT 'taxonomy' AS kind, CAST(protein_id AS VARCHAR) AS key, CAST(taxon AS VARCHAR) AS value FROM taxonomy
       UNION ALL SELECT 'ia', CAST(term AS VARCHAR), printf('%.4f', ia) FROM ia""")  # fmt: skip
def _(d):
    taxa, ia = scratch_path(d.spark), scratch_path(d.spark)
    d.taxonomy.write.csv(taxa, sep="\t")
    d.ia.write.csv(ia, sep="\t")
    left = readers.read_taxonomy(d.spark, taxa).select(F.lit("taxonomy").alias("kind"), F.col("protein_id").alias("key"), F.col("taxon").alias("value"))
    right = readers.read_ia(d.spark, ia).select(F.lit("ia"), "term", F.format_string("%.4f", "ia"))
    return left.union(right)


@query("src03_read_sequence_table", "SELECT CAST(protein_id AS VARCHAR) AS protein_id, sequence FROM proteins")
def _(d):
    path = scratch_path(d.spark) + ".tsv"
    d.proteins.select(F.col("protein_id").alias("ID"), F.lower("sequence").alias("Seq")).write.csv(path, sep="\t", header=True)
    return readers.read_sequence_table(d.spark, path, "ID", "Seq")


def _bucket_files(d, even_fasta: bool) -> str:
    """Documents in files of twenty, one folder per file."""
    path = scratch_path(d.spark)
    bucket = F.floor(F.col("protein_id") / 20)
    rows = d.proteins.withColumn("bucket", bucket)
    plain = F.regexp_replace("sequence", "(.{70})", "$1\n")
    fasta = F.concat(F.lit(">D"), "protein_id", F.lit(" x\n"), plain)
    text = F.when(bucket % 2 == 0, fasta).otherwise(plain) if even_fasta else plain
    shaped = rows.select("bucket", "protein_id", text.alias("value"))
    shaped.repartition("bucket").sortWithinPartitions("bucket", "protein_id").select("bucket", "value").write.partitionBy("bucket").text(path)
    return path


@query(
    "src04_read_plain_sequences",
    """SELECT CAST(protein_id // 20 AS VARCHAR) AS bucket, sha256(string_agg(sequence, '' ORDER BY protein_id)) AS checksum,
              CAST(sum(length(sequence)) AS BIGINT) AS letters FROM proteins GROUP BY 1""",
)
def _(d):
    rows = readers.read_plain_sequences(d.spark, _bucket_files(d, False) + "/*")
    bucket = F.regexp_extract("source_file", r"bucket=(\d+)", 1).alias("bucket")
    return rows.select(bucket, F.sha2("sequence", 256).alias("checksum"), big(F.length("sequence")).alias("letters"))


@query(
    "src05_read_sequence_dir",
    """SELECT CAST(protein_id // 20 AS VARCHAR) AS bucket, sha256(sequence) AS checksum, 'D' || protein_id AS protein_id,
              row_number() OVER (PARTITION BY protein_id // 20 ORDER BY protein_id) - 1 AS record_index
       FROM proteins WHERE (protein_id // 20) % 2 = 0 AND sequence <> ''
       UNION ALL SELECT CAST(protein_id // 20 AS VARCHAR), sha256(string_agg(sequence, '' ORDER BY protein_id)), 'stem', 0
       FROM proteins WHERE (protein_id // 20) % 2 = 1 GROUP BY 1""",
)
def _(d):
    rows = readers.read_sequence_dir(d.spark, _bucket_files(d, True))
    bucket = F.regexp_extract("source_file", r"bucket=(\d+)", 1).alias("bucket")
    name = F.when(F.col("protein_id").startswith("part-"), "stem").otherwise(F.col("protein_id"))
    return rows.select(bucket, F.sha2("sequence", 256).alias("checksum"), name.alias("protein_id"), "record_index")


def _obo(d):
    path = scratch_path(d.spark)
    go = lambda c: F.concat(F.lit("GO:"), c)
    links = d.edges.groupBy(F.col("child").alias("term")).agg(
        F.array_join(
            F.array_sort(
                F.collect_list(
                    F.when(F.col("parent") % 2 == 0, F.concat(F.lit("is_a: "), go("parent"), F.lit(" ! up")))
                    .otherwise(F.concat(F.lit("relationship: part_of "), go("parent"), F.lit(" ! whole")))
                )
            ),
            "\n",
        ).alias("links")
    )
    obsolete = F.when(F.col("term") % 13 == 0, "is_obsolete: true\n").otherwise("")
    text = F.concat(
        F.lit("[Term]\nid: "), go("term"), F.lit("\nname: "), "name", F.lit("\nnamespace: "), "namespace",
        F.lit('\ndef: "'), "definition", F.lit(' \\"quoted\\"" [src:1]\nrelationship: regulates GO:1\n'),
        F.coalesce(F.concat("links", F.lit("\n")), F.lit("")), obsolete,
    )
    other = d.ontology.limit(0).select(F.lit("").alias("value"))
    stanzas = d.ontology.join(links, "term", "left").select(text.alias("value"))
    tail = d.ontology.filter("term = 0").select(F.lit("[Typedef]\nid: part_of\nname: part of\nnamespace: external\n").alias("value"))
    stanzas.unionByName(other).unionByName(tail).write.text(path)
    return readers.read_obo(d.spark, path)


@query(
    "src06_read_obo_terms",
    """SELECT 'GO:' || term AS term, name, namespace, definition || ' "quoted"' AS definition FROM ontology WHERE term % 13 <> 0""",
)
def _(d):
    return _obo(d).terms


@query(
    "src06_read_obo_edges",
    "SELECT 'GO:' || child AS child, 'GO:' || parent AS parent, CASE WHEN parent % 2 = 0 THEN 'is_a' ELSE 'part_of' END AS rel FROM edges",
)
def _(d):
    return _obo(d).edges


@query("src07_read_id_list", "SELECT 'P' || o_orderkey AS protein_id FROM orders")
def _(d):
    path = scratch_path(d.spark)
    line = F.concat(F.lit("  P"), "o_orderkey", F.lit("\tnote"))
    lines = F.explode(F.array(line, F.lit("  "))).alias("value")
    d.table("orders").select(lines).write.text(path)
    return readers.read_id_list(d.spark, path)


@query("src08_read_term_list", "SELECT term_index, 'GO:' || term AS term FROM selected")
def _(d):
    path = scratch_path(d.spark)
    pair = F.struct("term_index", F.concat(F.lit("GO:"), "term").alias("t"))
    listed = prep.select_terms(d.annotations).agg(F.array_sort(F.collect_list(pair)).alias("x"))
    listed.select(F.to_json(F.transform("x", lambda p: p["t"])).alias("value")).write.text(path)
    return readers.read_term_list(d.spark, path).select(big("term_index").alias("term_index"), "term")


def message_files(d, topics: bool = False) -> str:
    path = scratch_path(d.spark)
    topic = F.lit("raw")
    if topics:
        topic = F.element_at(F.array(*map(F.lit, ("request_status", "prediction_result", "other"))), (F.col("position") % 3 + 1).cast("int"))
    d.messages.select("value", topic.alias("topic")).write.partitionBy("topic").text(path)
    return path


@query(
    "src09_read_events",
    """SELECT CASE event_id % 3 WHEN 0 THEN 'status' WHEN 1 THEN 'prediction' ELSE 'pipeline_event' END AS event_type,
              count(*) AS n FROM events GROUP BY 1""",
)
def _(d):
    kinds = {"request_status": "status", "prediction_result": "prediction"}
    stream = E.read_events(d.spark, message_files(d, True), kinds)
    return drain(stream).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "src10_read_eval_results",
    """SELECT result_set AS _result_set, CASE WHEN threshold > 0.5 THEN 'f_w' ELSE 'all' END AS _metric, method, namespace, count(*) AS n, round(max(f), 6) AS f
       FROM evaluations GROUP BY 1, 2, 3, 4""",
)
def _(d):
    from seqloom.functions.payload import resolve_columns

    root = scratch_path(d.spark)
    cols = [F.col("method").alias("filename"), F.col("namespace").alias("ns"), F.col("threshold").alias("tau"), "f", "f_w", "s"]
    for name in ("original", "regenerated"):
        rows = d.evaluations.filter(F.col("result_set") == name)
        rows.filter("threshold <= 0.5").select(*cols).write.csv(f"{root}/{name}/evaluation_all.tsv", sep="\t", header=True)
        rows.filter("threshold > 0.5").select(*cols).write.csv(f"{root}/{name}/evaluation_best_f_w.tsv", sep="\t", header=True)
    found = readers.read_eval_results(d.spark, {n: f"{root}/{n}" for n in ("original", "regenerated")})
    rows = resolve_columns(found)
    return rows.groupBy("_result_set", "_metric", "method", "namespace").agg(F.count("*").alias("n"), r6(F.max("f")).alias("f"))


@query(
    "src11_read_summaries",
    """SELECT record_count * 1000 AS planned_total_requests, round(count(*) / 60.0, 6) AS throughput_rps, round(CAST(max(latency_ms) AS DOUBLE), 6) AS latency_p95
       FROM load_results GROUP BY record_count""",
)
def _(d):
    path = scratch_path(d.spark)
    per = d.load_results.groupBy("record_count").agg((F.count("*") / 60.0).alias("throughput_rps"), F.max("latency_ms").alias("m"))
    shaped = per.select(
        (F.col("record_count") * 1000).alias("planned_total_requests"), "throughput_rps",
        F.struct(F.col("m").cast("double").alias("p95_est")).alias("latency_ms"), F.col("record_count").alias("bucket"),
    )
    shaped.write.partitionBy("bucket").json(path)
    rows = readers.read_summaries(d.spark, path + "/*/*.json")
    return rows.select("planned_total_requests", r6("throughput_rps").alias("throughput_rps"), r6("latency_p95").alias("latency_p95"))


@query(
    "src12_read_submission",
    """SELECT 'prediction' AS kind, 'P' || protein_id AS protein_id, 'GO:' || term AS term, round(score, 6) AS score FROM scores
       UNION ALL SELECT 'text', 'P' || doc_id, 'says  ' || lang || ' ' || source, 0.25 FROM documents""",
)
def _(d):
    path = scratch_path(d.spark)
    lines = d.scores.select(F.concat_ws("\t", F.concat(F.lit("P"), "protein_id"), F.concat(F.lit("GO:"), "term"), "score").alias("value"))
    texts = d.table("documents").select(
        F.concat(F.lit("P"), "doc_id", F.lit("\tText\t0.25\tsays  "), "lang", F.lit(" "), "source").alias("value")
    )
    lines.unionByName(texts).write.text(path)
    predictions, free = readers.read_submission(d.spark, path)
    left = predictions.select(F.lit("prediction").alias("kind"), "protein_id", "term", r6("score").alias("score"))
    return left.union(free.select(F.lit("text"), "protein_id", "text", "score"))


# --- writers -----------------------------------------------------------------------------------


@query(
    "snk01_write_predictions",
    "SELECT CAST(protein_id AS VARCHAR) AS protein_id, CAST(term AS VARCHAR) AS term, round(score, 6) AS score FROM scores",
)
def _(d):
    path = scratch_path(d.spark)
    writers.write_predictions(d.scores, path)
    rows = d.spark.read.schema(readers.PREDICTIONS).csv(path, sep="\t")
    return rows.withColumn("score", r6("score"))


@query(
    "snk02_write_ground_truth",
    "SELECT DISTINCT CAST(protein_id AS VARCHAR) AS protein_id, CAST(term AS VARCHAR) AS term FROM annotations",
)
def _(d):
    path = scratch_path(d.spark)
    writers.write_ground_truth(d.annotations, path)
    return d.spark.read.schema(readers.GROUND_TRUTH).csv(path, sep="\t")


@query("snk03_write_id_list", "SELECT 'P' || o_orderkey AS protein_id FROM orders")
def _(d):
    path = scratch_path(d.spark)
    writers.write_id_list(d.table("orders").select(F.concat(F.lit("P"), "o_orderkey").alias("protein_id")), path)
    return readers.read_id_list(d.spark, path)


@query("snk04_write_report", "SELECT method, namespace, round(max(f_w), 6) AS f_w, count(*) AS n FROM evaluations GROUP BY 1, 2")
def _(d):
    path = scratch_path(d.spark)
    report = d.evaluations.groupBy("method", "namespace").agg(F.max("f_w").alias("f_w"), F.count("*").alias("n"))
    writers.write_report(report, path)
    rows = d.spark.read.schema("method STRING, namespace STRING, f_w DOUBLE, n BIGINT").csv(path, header=True)
    return rows.withColumn("f_w", r6("f_w"))


@query(
    "snk05_write_events",
    "SELECT 'prediction_result' AS topic, protein_id AS key, request_id, seq FROM predictions",
)
def _(d):
    path = scratch_path(d.spark)
    writers.write_events(d.predictions, "protein_id", "prediction_result", path=path)
    raw = d.spark.read.schema("key STRING, value STRING, topic STRING").json(path)
    seq = F.get_json_object("value", "$.seq").cast("bigint").alias("seq")
    return raw.select("topic", "key", F.get_json_object("value", "$.request_id").alias("request_id"), seq)


@query(
    "snk11_truncate_tables",
    """SELECT 'prediction_history_by_protein' AS table_name, CAST(0 AS BIGINT) AS n
       UNION ALL SELECT 'kept', count(*) FROM predictions""",
)
def _(d):
    paths = {"prediction_history_by_protein": scratch_path(d.spark), "kept": scratch_path(d.spark)}
    for path in paths.values():
        d.predictions.write.parquet(path)
    tables.truncate_tables(d.spark, paths)
    out = None
    for name, path in paths.items():
        row = d.spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


# --- validation, scoring and event operators ---------------------------------------------------


def model(frame: pd.DataFrame, top_k: int, threshold: float | None) -> pd.DataFrame:
    """Fixed scorer: one term per protein from its third letter; fails for the largest top_k."""
    if top_k == 500:
        raise RuntimeError("model is out of memory")
    letter = frame["sequence"].str[2]
    answer = pd.DataFrame(
        {"protein_id": frame["protein_id"], "go_term": "GO:" + letter, "score": letter.map(lambda c: (ord(c) - 64) / 32)}
    )
    answer.attrs = {"name": "fixed", "threshold": threshold}
    return answer


GOOD = """good AS (SELECT *, CASE WHEN regexp_full_match(trim(raw_k), '[+-]?\\d+') THEN least(greatest(CAST(raw_k AS BIGINT), 1), 500) ELSE 20 END AS top_k,
            CASE WHEN try_cast(raw_t AS DOUBLE) IS NOT NULL THEN least(greatest(CAST(raw_t AS DOUBLE), 0.0), 1.0) ELSE -1.0 END AS threshold
          FROM parsed WHERE error_message IS NULL),
    uniq AS (SELECT count(DISTINCT (protein_id, sequence)) AS n FROM good)"""


@query(
    "st02_validated_stream",
    """SELECT 'valid' AS side, count(*) AS n FROM parsed WHERE error_message IS NULL
       UNION ALL SELECT 'dead', count(*) FROM parsed WHERE error_message IS NOT NULL""",
)
def _(d):
    stream = E.read_events(d.spark, message_files(d), {"raw": "raw_input"})
    parts = E.validated(stream)
    out = None
    for side, part in (("valid", parts.valid.select("request_id")), ("dead", parts.dead.select("request_id"))):
        row = drain(part).agg(F.count("*").alias("n")).select(F.lit(side).alias("side"), "n")
        out = row if out is None else out.unionByName(row)
    return out


@query("st03_dedupe_across_batches", "SELECT DISTINCT request_id FROM inbound")
def _(d):
    rows = d.inbound.withColumnRenamed("ts", "event_time")
    return drain(E.dedupe_across_batches(stream_table(rows), delay="60 days")).select("request_id")


SCORED = f"""WITH {GOOD}, k AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY protein_id, sequence ORDER BY position) = 1)"""


def _scored(d):
    valid = parse_events(d.messages).valid
    kept = request_parameters(dedupe.dedupe_events(valid, ["position"]))
    return P.score_batches(kept, model, ["position"])


@query(
    "st04_score_batches",
    f"""{SCORED}, c AS (SELECT *, sequence[3:3] AS letter, (row_number() OVER (PARTITION BY top_k, threshold ORDER BY position) - 1) // 64 AS ch FROM k WHERE top_k <> 500),
        t AS (SELECT top_k, threshold, ch, protein_id, letter, min(position) AS first_at, (ord(letter) - 64) / 32.0 AS score FROM c GROUP BY ALL),
        g AS (SELECT top_k, threshold, ch, protein_id, string_agg('GO:' || letter, ',' ORDER BY first_at) AS terms, max(score) AS max_score, count(*) AS n FROM t GROUP BY ALL)
        SELECT c.request_id, c.protein_id, terms, max_score, printf('top_terms=%d;max_score=%.6f', n, max_score) AS confidence
        FROM c JOIN g USING (top_k, threshold, ch, protein_id)""",
)
def _(d):
    rows = P.result_events(_scored(d))
    return rows.select(
        "request_id", "protein_id", F.array_join("predicted_terms", ",").alias("terms"),
        F.array_max(F.map_values("score_map")).alias("max_score"), F.col("confidence_summary").alias("confidence"),
    )


@query(
    "st05_failed_chunks",
    f"""{SCORED} SELECT request_id, protein_id, 'RuntimeError' AS error_code, 'model is out of memory' AS error_message FROM k WHERE top_k = 500""",
)
def _(d):
    return _scored(d).filter("error_code is not null").select("request_id", "protein_id", "error_code", "error_message")


@query(
    "st06_prediction_history",
    """SELECT protein_id, request_id, seq FROM predictions
       QUALIFY row_number() OVER (PARTITION BY protein_id, predicted_at, request_id ORDER BY seq DESC) = 1""",
)
def _(d):
    return requests.prediction_views(d.predictions)["prediction_history_by_protein"].select("protein_id", "request_id", "seq")


@query(
    "st06_prediction_by_request",
    """SELECT request_id, protein_id, seq FROM predictions
       QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY predicted_at DESC, seq DESC) = 1""",
)
def _(d):
    return requests.prediction_views(d.predictions)["prediction_by_request"].select("request_id", "protein_id", "seq")


@query(
    "st07_status_view_by_protein",
    "SELECT lower(protein_id) AS protein_bucket, request_id, current_status, seq FROM latest_log",
)
def _(d):
    view = requests.status_views(d.status_log)["requests_by_protein_window"]
    return view.select("protein_bucket", "request_id", "current_status", "seq")


@query(
    "st08_route_events",
    """WITH e AS (SELECT *, CASE seq % 4 WHEN 0 THEN 'prediction_result' WHEN 1 THEN 'dead_letter' WHEN 2 THEN 'request_status' ELSE 'other' END AS kind FROM status_log)
       SELECT 'status' AS target, CASE kind WHEN 'prediction_result' THEN 'completed' WHEN 'dead_letter' THEN 'failed' ELSE current_status END AS current_status,
              count(*) AS n FROM e WHERE kind <> 'other' GROUP BY 1, 2
       UNION ALL SELECT 'prediction', current_status, count(*) FROM e WHERE kind = 'prediction_result' GROUP BY 2
       UNION ALL SELECT 'dead_letter', current_status, count(*) FROM e WHERE kind = 'dead_letter' GROUP BY 2""",
)
def _(d):
    four = F.col("seq") % 4
    kind = F.when(four == 0, "prediction_result").when(four == 1, "dead_letter").when(four == 2, "request_status").otherwise("other")
    out = None
    for target, rows in E.route_events(d.status_log.withColumn("event_type", kind)).items():
        part = rows.groupBy(F.lit(target).alias("target"), "current_status").agg(F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "st09_live_status",
    """SELECT request_id, current_status, seq FROM status_log
         QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, seq DESC) = 1""",
)
def _(d):
    live = drain(E.live_status(stream_table(d.status_log.repartition(4, "seq"), 2)), "update", ["request_id"])
    return live.select("request_id", "current_status", "seq")


@query(
    "st10_events_per_minute",
    f"SELECT strftime(date_trunc('minute', ts), {FMT}) AS window_start, count(*) AS metric_value FROM events GROUP BY 1",
)
def _(d):
    stream = E.events_per_minute(stream_table(d.table("events").select("ts", "event_type")))
    rows = drain(stream, "update", ["window_start"])
    return rows.select(stamp("window_start").alias("window_start"), "metric_value")


@query(
    "st11_rolling_latency",
    """WITH l AS (SELECT latency_ms FROM status_log WHERE latency_ms IS NOT NULL ORDER BY updated_at DESC, seq DESC LIMIT 5000),
       v AS (SELECT latency_ms, row_number() OVER (ORDER BY latency_ms) - 1 AS i, count(*) OVER () AS n FROM l)
       SELECT CAST(round_even(avg(latency_ms), 0) AS BIGINT) AS avg_latency_ms,
              max(latency_ms) FILTER (WHERE i = CAST(round_even((n - 1) * 0.95, 0) AS BIGINT)) AS p95_latency_ms FROM v""",
)
def _(d):
    return E.rolling_latency(d.status_log, [F.desc("updated_at"), F.desc("seq")])


@query(
    "st12_retry_events",
    """SELECT 'r' || event_id AS request_id, 'P' || user_id AS protein_id, 'MKLV' AS sequence,
              CASE WHEN event_id % 3 = 2 THEN 'api' WHEN event_id % 2 = 0 THEN 'ops' ELSE 'retry_worker' END AS source, sha256('MKLV') AS checksum,
              CAST(CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE 7 END AS BIGINT) AS retry_count,
              '{"retry_count":"' || (CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE 7 END) || '","retry_source":"' ||
              (CASE WHEN event_id % 2 = 0 THEN 'ops' ELSE 'retry_worker' END) || '"}' AS metadata
       FROM events WHERE event_id % 3 <> 2
       UNION ALL SELECT 'r' || event_id, 'P' || user_id, 'MKLV', 'api', sha256('MKLV'), CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE 7 END,
              '{"retry_count":"' || (CASE WHEN event_id % 2 = 0 THEN event_id % 5 ELSE 7 END) || '","retry_source":"api"}'
       FROM events WHERE event_id % 3 = 2""",
)
def _(d):
    i = F.col("event_id")
    field = F.when(i % 2 == 0, '"sequence":"mk lv"').otherwise('"sequence":"","sequence_raw":"MKLV"')
    inner = F.concat(
        F.lit('{"request_id":"r'), i, F.lit('","protein_id":"P'), "user_id", F.lit('",'), field,
        F.lit(',"metadata":{"retry_count":7}}'),
    )
    extra = F.when(i % 2 == 0, F.concat(F.lit(',"retry_count":'), i % 5, F.lit(',"source":"ops"'))).otherwise("")
    wrapped = F.when(i % 3 == 0, F.concat(F.lit('{"raw_event":'), inner, extra, F.lit("}"))).when(
        i % 3 == 1, F.concat(F.lit('{"payload":'), inner, extra, F.lit("}"))
    )
    # a bare payload carries the outer fields itself
    bare = F.concat(
        F.lit('{"request_id":"r'), i, F.lit('","protein_id":"P'), "user_id", F.lit('",'), field,
        F.lit(',"metadata":{"retry_count":7},"source":"api"'),
        F.when(i % 2 == 0, F.concat(F.lit(',"retry_count":'), i % 5)).otherwise(""), F.lit("}"),
    )
    rows = d.table("events").select(F.coalesce(wrapped, bare).alias("payload"))
    out = E.retry_events(rows).withColumn("retry_count", big("retry_count"))
    return out.select("request_id", "protein_id", "sequence", "source", "checksum", "retry_count", "metadata")


@query(
    "st12_retry_failures",
    """WITH f AS (SELECT request_id, max(coalesce(retry_count, 0)) + 1 AS n FROM status_log WHERE current_status = 'failed' AND error_code IS NOT NULL GROUP BY 1)
       SELECT s.seq, s.request_id, 'RETRYING' AS current_status, CAST(f.n AS BIGINT) AS retry_count FROM status_log s JOIN f ON f.request_id = s.request_id""",
)
def _(d):
    failures = d.status_log.filter("current_status = 'failed'").withColumn("retryable", F.col("error_code").isNotNull())
    rows = E.retry_failures(failures, d.status_log.select("request_id", "seq"))
    return rows.select("seq", "request_id", "current_status", big("retry_count").alias("retry_count"))


@query(
    "st13_replay",
    """WITH r AS (SELECT protein_id, sequence, row_number() OVER (ORDER BY protein_id) AS i FROM proteins)
       SELECT i AS replay_index, protein_id, sha256(CASE WHEN i % 7 = 0 THEN sequence || '*' ELSE sequence END) AS checksum,
              i % 7 <> 0 AND sequence <> '' AND length(sequence) <= 20000 AS accepted,
              '{"campaign_id":"c1","producer_id":"replay_service","replay_index":"' || i || '"}' AS metadata FROM r""",
)
def _(d):
    rows = E.replay(d.proteins, "c1", ["protein_id"], every=7)
    return rows.select("replay_index", "protein_id", F.sha2("sequence", 256).alias("checksum"), "accepted", "metadata")


@query(
    "st13_replay_counts",
    """WITH r AS (SELECT sequence, row_number() OVER (ORDER BY protein_id) AS i FROM proteins),
       a AS (SELECT i % 7 <> 0 AND sequence <> '' AND length(sequence) <= 20000 AS ok FROM r)
       SELECT count(*) AS emitted, count(*) FILTER (WHERE ok) AS accepted, count(*) FILTER (WHERE NOT ok) AS failed FROM a""",
)
def _(d):
    return E.replay_counts(E.replay(d.proteins, "c1", ["protein_id"], every=7))


@query(
    "st14_complete_requests",
    """SELECT request_id, CAST(max(sequence_length) AS BIGINT) AS latency_ms, count(*) AS protein_result_count,
              count(DISTINCT position % 3) AS modal_chunk_count, 'completed' AS current_status FROM request_records GROUP BY 1""",
)
def _(d):
    chunks = d.request_records.select(
        "request_id", (F.col("position") % 3).alias("chunk_index"), "protein_id",
        F.col("sequence_length").alias("latency_ms"), F.lit("m1").alias("model_version"),
    )
    rows = E.complete_requests(chunks)
    return rows.select("request_id", big("latency_ms").alias("latency_ms"), "protein_result_count", "modal_chunk_count", "current_status")


@query(
    "st15_analysis_from_batch",
    """WITH rows AS (SELECT protein_id // 10 AS batch_id, protein_id, term, score FROM scores),
       wanted AS (SELECT o_orderkey // 10 AS batch_id, o_orderkey AS protein_id FROM orders),
       own AS (SELECT w.batch_id, w.protein_id, r.term, r.score FROM wanted w JOIN rows r USING (batch_id, protein_id)
               QUALIFY row_number() OVER (PARTITION BY w.protein_id ORDER BY r.score DESC, r.term) <= 2),
       shared AS (SELECT batch_id, term, score FROM rows QUALIFY row_number() OVER (PARTITION BY batch_id ORDER BY score DESC, term) <= 2)
       SELECT protein_id, term, round(score, 6) AS score FROM own
       UNION ALL SELECT w.protein_id, s.term, round(s.score, 6) FROM wanted w JOIN shared s USING (batch_id) WHERE w.protein_id NOT IN (SELECT protein_id FROM rows)""",
)
def _(d):
    batch = F.floor(F.col("protein_id") / 10).alias("batch_id")
    rows = d.scores.select(batch, "protein_id", "term", "score")
    out = E.analysis_from_batch(d.scored_proteins.select(batch, "protein_id"), rows, 2)
    return out.select("protein_id", "term", r6("score").alias("score"))


@query(
    "st16_retryable",
    """SELECT error_code, stage_name, count(*) AS n, bool_and(NOT (stage_name = 'spark_validation' OR coalesce(error_code, '') = 'INVALID_SEQUENCE')) AS may_retry
       FROM (SELECT CASE WHEN seq % 3 = 0 THEN 'INVALID_SEQUENCE' ELSE error_code END AS error_code,
                    CASE WHEN seq % 2 = 0 THEN 'spark_validation' ELSE 'modal_inference' END AS stage_name FROM status_log) GROUP BY 1, 2""",
)
def _(d):
    rows = d.status_log.select(
        F.when(F.col("seq") % 3 == 0, "INVALID_SEQUENCE").otherwise(F.col("error_code")).alias("error_code"),
        F.when(F.col("seq") % 2 == 0, "spark_validation").otherwise("modal_inference").alias("stage_name"),
    )
    ok = S.retryable(F.col("error_code"), F.col("stage_name"))
    return rows.withColumn("ok", ok).groupBy("error_code", "stage_name").agg(F.count("*").alias("n"), F.bool_and("ok").alias("may_retry"))


@query(
    "st17_feature_snapshots",
    """SELECT request_id, protein_id, 'sequence_v1' AS feature_version, sha256(protein_id || ':' || sequence || ':{"threshold":' ||
              (CASE WHEN raw_t IS NULL THEN 'null' ELSE '"' || raw_t || '"' END) || ',"top_k":"' || raw_k || '"}') AS feature_hash,
              'cassandra://raw_protein_events/' || request_id AS feature_payload_ref FROM parsed WHERE error_message IS NULL""",
)
def _(d):
    return E.feature_snapshots(parse_events(d.messages).valid)


