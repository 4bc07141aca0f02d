"""Domain tables derived from the generated star-schema tables.

Every table exists twice: as a DataFrame here, and as SQL text for the checking database. Both use
integer arithmetic for keys, so they agree exactly.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.session import configure, ship_package

SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING, l_shipdate TIMESTAMP",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
}

STATUS_OF = {"view": "processing", "click": "completed", "purchase": "completed", "signup": "pending", "error": "failed"}
BRANCHES = ("esm_mlp", "protcnn", "bilstm")
ASPECTS = ("MF", "BP", "CC")


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


class Domain:
    """Lazily built domain tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        ship_package(spark)
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def status_log(self) -> DataFrame:
        e = self.table("events")
        statuses = F.create_map(*[F.lit(x) for pair in STATUS_OF.items() for x in pair])
        k = F.get_json_object("props", "$.k").cast("int")
        failed = F.col("event_type") == "error"
        return e.select(
            F.concat(F.lit("r"), F.floor(F.col("event_id") / 4)).alias("request_id"),
            F.concat(F.lit("P"), F.col("user_id") % 97).alias("protein_id"),
            F.concat(F.lit("u"), "user_id").alias("username"),
            F.when(F.col("event_id") % 3 == 0, "api").when(F.col("event_id") % 3 == 1, "replay").alias("source"),
            F.timestamp_micros(F.unix_micros("ts") - (F.col("event_id") % 7) * 60000000).alias("created_at"),
            F.col("ts").alias("updated_at"),
            F.element_at(statuses, F.col("event_type")).alias("current_status"),
            F.concat(F.lit("stage_"), "event_type").alias("stage_name"),
            F.when(failed & (F.col("event_id") % 5 != 0), F.concat(F.lit("E"), k % 3)).alias("error_code"),
            F.when(failed, F.lit("boom")).alias("error_message"),
            F.when(F.col("event_id") % 4 == 3, F.lit(1)).alias("retry_count"),
            F.lit("m1").alias("model_version"),
            F.lit("f1").alias("feature_version"),
            F.round(F.col("value") * 10).cast("bigint").alias("latency_ms"),
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def inbound(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.concat(F.lit("q"), F.floor(F.col("event_id") / 2)).alias("request_id"),
            F.concat(F.lit("P"), "user_id").alias("protein_id"),
            F.sha2("props", 256).alias("checksum"),
            F.col("event_id").alias("position"),
            "ts",
        )

    @cached_property
    def messages(self) -> DataFrame:
        """Raw JSON messages; one in seven is malformed, blank or invalid in each way."""
        e = self.table("events")
        kind = F.col("event_id") % 7
        pid = F.when(kind == 1, "  ").otherwise(F.concat(F.lit(" P"), "user_id", F.lit(" ")))
        letters = F.translate(F.md5("props"), "0123456789", "ACDEFGHIKL")
        seq = F.when(kind == 2, "MTE*").when(kind == 3, " ").otherwise(F.concat(F.lit("mk "), letters))
        five, four = F.col("event_id") % 5, F.col("event_id") % 4
        top = F.when(five == 0, '"700"').when(five == 1, '"abc"').when(five == 2, "-4")
        top = top.otherwise((F.col("event_id") % 50).cast("string"))
        limit = F.when(four == 0, "null").when(four == 1, "1.7").when(four == 2, '"x"').otherwise("0.25")
        whole = F.concat(
            F.lit('{"request_id":"r'), "event_id", F.lit('","protein_id":"'), pid, F.lit('","sequence":"'), seq,
            F.lit('","event_time":"'), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            F.lit('","metadata":{"top_k":'), top, F.lit(',"threshold":'), limit, F.lit("}}"),
        )
        broken = F.concat(F.lit('{"request_id":"r'), "event_id")
        return e.select(F.col("event_id").alias("position"), F.when(kind == 0, broken).otherwise(whole).alias("value"))

    @cached_property
    def proteins(self) -> DataFrame:
        letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
        return self.table("documents").select(F.col("doc_id").alias("protein_id"), letters.alias("sequence"))

    @cached_property
    def annotations(self) -> DataFrame:
        index = (F.col("l_partkey") + F.when(F.col("l_linenumber") == 7, 1).otherwise(0)) % 3
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("protein_id"),
            F.col("l_partkey").alias("term"),
            _pick(index, ASPECTS).alias("aspect"),
        )

    @cached_property
    def taxonomy(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("protein_id"), F.col("o_custkey").alias("taxon"))

    @cached_property
    def ia(self) -> DataFrame:
        p = self.table("part").filter(F.col("p_partkey") % 10 != 0)
        return p.select(F.col("p_partkey").alias("term"), (F.col("p_retailprice") / 1000).alias("ia"))

    @cached_property
    def ontology(self) -> DataFrame:
        names = ("molecular_function", "biological_process", "cellular_component")
        return self.table("part").select(
            F.col("p_partkey").alias("term"),
            F.col("p_name").alias("name"),
            _pick(F.col("p_partkey") % 3, names).alias("namespace"),
            _pick(F.col("p_partkey") % 3, ASPECTS).alias("aspect"),
            F.concat(F.lit("def of "), "p_type").alias("definition"),
        )

    @cached_property
    def edges(self) -> DataFrame:
        p = self.table("part").filter("p_partkey > 0")
        parents = F.array_distinct(F.array(F.floor(F.col("p_partkey") / 2), F.floor(F.col("p_partkey") / 3)))
        return p.select(F.col("p_partkey").alias("child"), F.explode(parents).alias("parent"))

    @cached_property
    def branch_scores(self) -> DataFrame:
        return (
            self.table("lineitem")
            .groupBy(
                _pick(F.col("l_linenumber") % 3, BRANCHES).alias("model"),
                F.col("l_orderkey").alias("protein_id"),
                F.col("l_partkey").alias("term"),
            )
            .agg((F.max("l_quantity") / 50).alias("score"))
        )

    @cached_property
    def scores(self) -> DataFrame:
        return self.table("lineitem").groupBy(F.col("l_orderkey").alias("protein_id"), F.col("l_partkey").alias("term")).agg(
            (F.max("l_quantity") / 50).alias("score")
        )

    @cached_property
    def truth(self) -> DataFrame:
        rows = self.table("lineitem").filter(F.col("l_returnflag") == "R")
        return rows.select(F.col("l_orderkey").alias("protein_id"), F.col("l_partkey").alias("term")).distinct()

    @cached_property
    def scored_proteins(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("protein_id"))

    @cached_property
    def scored_terms(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("term"), (F.col("p_partkey")).alias("term_index"))

    @cached_property
    def request_records(self) -> DataFrame:
        line = self.table("lineitem")
        return line.select(
            F.col("l_orderkey").alias("request_id"),
            F.concat(F.lit("P"), "l_partkey").alias("protein_id"),
            F.col("l_linenumber").alias("position"),
            F.col("l_quantity").cast("int").alias("sequence_length"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_suppkey").alias("supplier"),
        )

    @cached_property
    def request_log(self) -> DataFrame:
        e = self.table("events")
        return e.select(
            F.col("event_type").alias("path"),
            F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
            (F.col("value") / 100).alias("duration_s"),
            "ts",
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def load_results(self) -> DataFrame:
        e = self.table("events")
        failed = F.col("event_type") == "error"
        return e.select(
            F.concat(F.lit("req-"), "event_id").alias("request_label"),
            (F.col("event_id") % 10 + 1).alias("record_count"),
            F.when(failed, "failed").otherwise("completed").alias("status"),
            F.when(failed, F.concat(F.lit("error "), "props")).alias("error"),
            F.round(F.col("value") * 10).cast("bigint").alias("latency_ms"),
            (F.col("event_id") + 1).alias("seq"),
            ((F.col("event_id") + 1) / 100.0).alias("elapsed_seconds"),
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """Prediction log: one row per inbound event that completed."""
        e = self.table("events").filter(F.col("event_type").isin("click", "purchase"))
        return e.select(
            F.concat(F.lit("r"), F.floor(F.col("event_id") / 4)).alias("request_id"),
            F.concat(F.when(F.col("event_id") % 2 == 0, "P").otherwise("p"), F.col("user_id") % 97).alias("protein_id"),
            F.col("ts").alias("predicted_at"),
            F.round(F.col("value"), 2).alias("max_score"),
            F.col("event_id").alias("seq"),
        )

    @cached_property
    def evaluations(self) -> DataFrame:
        """Evaluator-like table: method, namespace, threshold and measures."""
        line = self.table("lineitem")
        return line.select(
            F.concat(F.lit("m"), F.col("l_suppkey") % 5).alias("method"),
            _pick(F.col("l_partkey") % 3, ASPECTS).alias("namespace"),
            (F.col("l_quantity") / 50).alias("threshold"),
            (F.col("l_discount") * 10).alias("f"),
            (F.col("l_tax") * 10).alias("f_w"),
            (F.col("l_extendedprice") / 1000).alias("s"),
            F.when(F.col("l_linestatus") == "O", "original").otherwise("regenerated").alias("result_set"),
            (F.col("l_orderkey") * 10000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("position"),
            F.col("l_suppkey").alias("tie"),
        )


# SQL text of the same tables.
CTES: dict[str, str] = {
    "status_log": """
        SELECT 'r' || (event_id // 4) AS request_id, 'P' || (user_id % 97) AS protein_id, 'u' || user_id AS username,
               CASE event_id % 3 WHEN 0 THEN 'api' WHEN 1 THEN 'replay' END AS source,
               ts - to_minutes(event_id % 7) AS created_at, ts AS updated_at,
               CASE event_type WHEN 'view' THEN 'processing' WHEN 'click' THEN 'completed' WHEN 'purchase' THEN 'completed'
                               WHEN 'signup' THEN 'pending' ELSE 'failed' END AS current_status,
               'stage_' || event_type AS stage_name,
               CASE WHEN event_type = 'error' AND event_id % 5 <> 0
                    THEN 'E' || (CAST(json_extract_string(props, '$.k') AS INT) % 3) END AS error_code,
               CASE WHEN event_type = 'error' THEN 'boom' END AS error_message,
               CASE WHEN event_id % 4 = 3 THEN 1 END AS retry_count, 'm1' AS model_version, 'f1' AS feature_version,
               CAST(round(value * 10) AS BIGINT) AS latency_ms, event_id AS seq
        FROM events""",
    "latest_log": """
        SELECT * FROM status_log
        QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, seq DESC) = 1""",
    "inbound": """
        SELECT 'q' || (event_id // 2) AS request_id, 'P' || user_id AS protein_id, sha256(props) AS checksum,
               event_id AS position, ts FROM events""",
    "messages": """
        SELECT event_id AS position, CASE WHEN event_id % 7 = 0 THEN '{"request_id":"r' || event_id
          ELSE '{"request_id":"r' || event_id || '","protein_id":"' ||
               (CASE WHEN event_id % 7 = 1 THEN '  ' ELSE ' P' || user_id || ' ' END) || '","sequence":"' ||
               (CASE event_id % 7 WHEN 2 THEN 'MTE*' WHEN 3 THEN ' '
                ELSE 'mk ' || translate(md5(props), '0123456789', 'ACDEFGHIKL') END) ||
               '","event_time":"' || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '","metadata":{"top_k":' ||
               (CASE event_id % 5 WHEN 0 THEN '"700"' WHEN 1 THEN '"abc"' WHEN 2 THEN '-4' ELSE CAST(event_id % 50 AS VARCHAR) END)
               || ',"threshold":' || (CASE event_id % 4 WHEN 0 THEN 'null' WHEN 1 THEN '1.7' WHEN 2 THEN '"x"' ELSE '0.25' END)
               || '}}' END AS value FROM events""",
    "parsed": """
        SELECT position, value, CASE WHEN json_valid(value) THEN json_extract_string(value, '$.request_id') END AS request_id,
               CASE WHEN json_valid(value) THEN trim(json_extract_string(value, '$.protein_id')) END AS protein_id,
               CASE WHEN json_valid(value)
                    THEN upper(regexp_replace(json_extract_string(value, '$.sequence'), '\\s+', '', 'g')) END AS sequence,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.metadata.top_k') END AS raw_k,
               CASE WHEN json_valid(value) THEN json_extract_string(value, '$.metadata.threshold') END AS raw_t,
               CASE WHEN NOT json_valid(value) THEN 'malformed JSON'
                    WHEN trim(json_extract_string(value, '$.protein_id')) = '' THEN 'protein_id must not be blank'
                    WHEN trim(json_extract_string(value, '$.sequence')) = '' THEN 'sequence must not be blank'
                    WHEN NOT regexp_full_match(upper(regexp_replace(json_extract_string(value, '$.sequence'), '\\s+', '', 'g')), '[A-Z]+')
                    THEN 'sequence contains invalid amino-acid characters' END AS error_message
        FROM messages""",
    "proteins": """
        SELECT doc_id AS protein_id, upper(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS sequence FROM documents""",
    "annotations": """
        SELECT l_orderkey AS protein_id, l_partkey AS term,
               (['MF','BP','CC'])[(l_partkey + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END) % 3 + 1] AS aspect
        FROM lineitem""",
    "taxonomy": "SELECT o_orderkey AS protein_id, o_custkey AS taxon FROM orders",
    "ia": "SELECT p_partkey AS term, p_retailprice / 1000 AS ia FROM part WHERE p_partkey % 10 <> 0",
    "ontology": """
        SELECT p_partkey AS term, p_name AS name,
               (['molecular_function','biological_process','cellular_component'])[p_partkey % 3 + 1] AS namespace,
               (['MF','BP','CC'])[p_partkey % 3 + 1] AS aspect, 'def of ' || p_type AS definition FROM part""",
    "edges": """
        SELECT DISTINCT p_partkey AS child, parent
        FROM part, LATERAL (SELECT unnest([p_partkey // 2, p_partkey // 3]) AS parent) WHERE p_partkey > 0""",
    "closure": """
        SELECT child AS term, parent AS ancestor FROM edges
        UNION
        SELECT c.term, e.parent FROM closure c JOIN edges e ON e.child = c.ancestor""",
    "branch_scores": """
        SELECT (['esm_mlp','protcnn','bilstm'])[l_linenumber % 3 + 1] AS model, l_orderkey AS protein_id, l_partkey AS term,
               max(l_quantity) / 50 AS score FROM lineitem GROUP BY 1, 2, 3""",
    "scores": "SELECT l_orderkey AS protein_id, l_partkey AS term, max(l_quantity) / 50 AS score FROM lineitem GROUP BY 1, 2",
    "truth": "SELECT DISTINCT l_orderkey AS protein_id, l_partkey AS term FROM lineitem WHERE l_returnflag = 'R'",
    "scored_proteins": "SELECT o_orderkey AS protein_id FROM orders",
    "scored_terms": "SELECT p_partkey AS term, p_partkey AS term_index FROM part",
    "pairs": """
        SELECT coalesce(t.protein_id, s.protein_id) AS protein_id, coalesce(t.term, s.term) AS term, s.score,
               CASE WHEN t.term IS NULL THEN 0 ELSE 1 END AS label
        FROM truth t FULL OUTER JOIN scores s ON t.protein_id = s.protein_id AND t.term = s.term""",
    "request_records": """
        SELECT l_orderkey AS request_id, 'P' || l_partkey AS protein_id, l_linenumber AS position,
               CAST(l_quantity AS INT) AS sequence_length, l_extendedprice AS price, l_suppkey AS supplier FROM lineitem""",
    "request_log": """
        SELECT event_type AS path, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
               value / 100 AS duration_s, ts, event_id AS seq FROM events""",
    "load_results": """
        SELECT 'req-' || event_id AS request_label, event_id % 10 + 1 AS record_count,
               CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status,
               CASE WHEN event_type = 'error' THEN 'error ' || props END AS error,
               CAST(round(value * 10) AS BIGINT) AS latency_ms, event_id + 1 AS seq,
               (event_id + 1) / 100.0 AS elapsed_seconds FROM events""",
    "predictions": """
        SELECT 'r' || (event_id // 4) AS request_id,
               (CASE WHEN event_id % 2 = 0 THEN 'P' ELSE 'p' END) || (user_id % 97) AS protein_id,
               ts AS predicted_at, round(value, 2) AS max_score, event_id AS seq
        FROM events WHERE event_type IN ('click', 'purchase')""",
    "evaluations": """
        SELECT 'm' || (l_suppkey % 5) AS method, (['MF','BP','CC'])[l_partkey % 3 + 1] AS namespace,
               l_quantity / 50 AS threshold, l_discount * 10 AS f, l_tax * 10 AS f_w, l_extendedprice / 1000 AS s,
               CASE WHEN l_linestatus = 'O' THEN 'original' ELSE 'regenerated' END AS result_set,
               l_orderkey * 10000000 + l_partkey * 100 + l_linenumber AS position, l_suppkey AS tie FROM lineitem""",
    "selected": """
        SELECT term, count(*) AS frequency, row_number() OVER (ORDER BY count(*) DESC, term) - 1 AS term_index
        FROM annotations GROUP BY term HAVING count(*) >= 8 ORDER BY count(*) DESC, term LIMIT 3000""",
    "strata": """
        SELECT protein_id, CASE WHEN count(*) OVER (PARTITION BY s) >= 5 THEN s ELSE 'rare' END AS stratum
        FROM (SELECT protein_id,
                     coalesce(nullif((CASE WHEN bool_or(aspect = 'MF') THEN 'MF' ELSE '' END)
                       || (CASE WHEN bool_or(aspect = 'BP') THEN 'BP' ELSE '' END)
                       || (CASE WHEN bool_or(aspect = 'CC') THEN 'CC' ELSE '' END), ''), 'UNK') || '_' ||
                     CASE WHEN count(DISTINCT term) <= 3 THEN 'few' WHEN count(DISTINCT term) <= 10 THEN 'mid' ELSE 'many' END AS s
              FROM annotations GROUP BY protein_id)""",
    "splits": """
        SELECT protein_id, stratum,
               CASE WHEN place <= round_even(size * 0.15, 0) THEN 'test'
                    WHEN place <= round_even(size * 0.15, 0) * 2 THEN 'valid' ELSE 'train' END AS split
        FROM (SELECT *, count(*) OVER (PARTITION BY stratum) AS size,
                     row_number() OVER (PARTITION BY stratum ORDER BY md5('42:' || protein_id), protein_id) AS place
              FROM strata)""",
    "label_pairs": """
        SELECT DISTINCT a.protein_id, s.term_index FROM annotations a JOIN selected s ON a.term = s.term""",
    "graph_labels": """
        SELECT a.protein_id, a.term FROM annotations a WHERE a.term IN (SELECT term FROM selected)
        UNION
        SELECT a.protein_id, c.ancestor FROM annotations a JOIN closure c ON c.term = a.term
        WHERE c.ancestor IN (SELECT term FROM selected)""",
}

_WORD = {name: re.compile(rf"\b{name}\b") for name in CTES}


def with_tables(body: str) -> str:
    """Prefix ``body`` with the definitions of every domain table it uses."""
    body = body.strip()
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, word in _WORD.items():
            if name not in needed and word.search(text):
                if CTES[name] is not text:
                    visit_text = CTES[name]
                    needed.append(name)
                    visit(visit_text)

    visit(body)
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in needed:
            if other != name and _WORD[other].search(CTES[name]):
                place(other)
        ordered.append(name)

    for name in needed:
        place(name)
    if not ordered:
        return body
    own = ""
    match = re.match(r"WITH\s+(RECURSIVE\s+)?", body)
    if match:
        own, body = ", " + body[match.end() :], ""
    tables = ", ".join(f"{n} AS ({CTES[n].strip()})" for n in ordered)
    recursive = "RECURSIVE " if "closure" in ordered or (match and match.group(1)) else ""
    return f"WITH {recursive}{tables}{own} {body}".strip()


def shape(df: DataFrame, **columns) -> DataFrame:
    """Final projection with plain types: counts as bigint, doubles rounded."""
    return df.select(*[c.alias(n) for n, c in columns.items()])


def big(c) -> object:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def r6(c) -> object:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 6)


def r4(c) -> object:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), 4)


def stamp(c) -> object:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


__all__ = ["CTES", "Domain", "S", "big", "r4", "r6", "shape", "stamp", "with_tables"]
