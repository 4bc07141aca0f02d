"""Registered queries: scalar, string, JSON, array and map functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.functions import payload as P
from seqloom.functions import scalars as S
from seqloom.functions import validate as V
from seqloom.operators import agg, naming, requests
from seqloom.plans.domain import big, r6, stamp
from seqloom.plans.registry import query

PARAMETERS = """
    CASE WHEN regexp_full_match(trim(raw_k), '[+-]?\\d+') THEN least(greatest(CAST(raw_k AS BIGINT), 1), 500) ELSE 20 END AS top_k,
    CASE WHEN try_cast(raw_t AS DOUBLE) IS NOT NULL THEN least(greatest(CAST(raw_t AS DOUBLE), 0.0), 1.0) END AS threshold"""


@query(
    "e01_parse_events",
    f"""SELECT request_id, protein_id, sequence, sha256(sequence) AS checksum, {PARAMETERS}
        FROM parsed WHERE error_message IS NULL""",
)
def _(d):
    valid = V.request_parameters(V.parse_events(d.messages).valid)
    return valid.select("request_id", "protein_id", "sequence", "checksum", big("top_k").alias("top_k"), "threshold")


@query(
    "e01_dead_letters",
    """SELECT 'unknown' AS request_id, 'spark_validation' AS stage_name, error_message,
              CASE WHEN error_message = 'malformed JSON' THEN 'JSONDecodeError' ELSE 'ValidationError' END AS error_code,
              value AS raw_value
       FROM parsed WHERE error_message IS NOT NULL""",
)
def _(d):
    dead = V.parse_events(d.messages).dead
    return dead.select(
        "request_id", "stage_name", "error_message", "error_code",
        F.get_json_object("payload", "$.raw_value").alias("raw_value"),
    )


@query(
    "e02_trim_ids",
    """SELECT position, trim(json_extract_string(value, '$.protein_id')) AS protein_id,
              trim(json_extract_string(value, '$.protein_id')) = '' AS is_blank
       FROM messages WHERE json_valid(value)""",
)
def _(d):
    pid = S.trimmed_id(F.get_json_object("value", "$.protein_id"))
    return d.messages.filter(pid.isNotNull()).select("position", pid.alias("protein_id"), (pid == "").alias("is_blank"))


@query(
    "e03_normalize_sequence",
    r"""SELECT doc_id, upper(replace(regexp_replace(text, '[\s\x0b\x1c-\x1f\x{85}\pZ]+', '', 'g'), 'ß', 'SS')) AS sequence
        FROM documents""",
)
def _(d):
    return d.table("documents").select("doc_id", S.normalize_sequence(F.col("text")).alias("sequence"))


@query(
    "e04_validate",
    """SELECT protein_id,
         CASE WHEN sequence = '' THEN 'sequence must not be blank'
              WHEN length(sequence) > 20000 THEN 'sequence length exceeds 20000 amino acids'
              WHEN NOT regexp_full_match(sequence, '[A-Z]+') THEN 'sequence contains invalid amino-acid characters' END AS event_error,
         CASE WHEN sequence = '' THEN 'Sequence is required.'
              WHEN regexp_replace(sequence, '[ACDEFGHIKLMNPQRSTVWY]', '', 'g') <> '' THEN
                'Sequence contains unsupported symbols: ' || array_to_string(list_sort(list_distinct(string_split(
                  regexp_replace(sequence, '[ACDEFGHIKLMNPQRSTVWY]', '', 'g'), ''))), ', ') || '.' END AS api_error,
         CASE WHEN sequence = '' THEN 'Sequence is required.'
              WHEN NOT regexp_full_match(sequence, '[ACDEFGHIKLMNPQRSTVWY]+')
                THEN 'Sequence can only contain standard amino acid symbols: ACDEFGHIKLMNPQRSTVWY.'
              WHEN length(sequence) < 10 THEN 'Sequence is too short for a useful inference request.'
              WHEN length(sequence) > 10000 THEN 'Sequence is too long for the current UI limit.' END AS ui_error
       FROM proteins""",
)
def _(d):
    seq = F.col("sequence")
    return d.proteins.select(
        "protein_id", *[S.sequence_error(seq, p).alias(f"{p}_error") for p in ("event", "api", "ui")]
    )


@query(
    "e05_invalid_symbols",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(
              regexp_replace(upper(regexp_replace(text, '[^A-Za-z0-9]', '', 'g')), '[ACDEFGHIKLMNPQRSTVWY]', '', 'g'), ''))), ',') AS symbols
       FROM documents""",
)
def _(d):
    clean = F.upper(F.regexp_replace("text", "[^A-Za-z0-9]", ""))
    return d.table("documents").select("doc_id", F.array_join(S.invalid_symbols(clean), ",").alias("symbols"))


@query("e06_checksum", "SELECT protein_id, sha256(sequence) AS checksum FROM proteins")
def _(d):
    return d.proteins.select("protein_id", S.checksum(F.col("sequence")).alias("checksum"))


@query(
    "e07_shard",
    """SELECT shard, count(*) AS n FROM (
         SELECT ('0x' || right(sha256(request_id), 8))::BIGINT % 32 AS shard FROM status_log) GROUP BY shard""",
)
def _(d):
    return d.status_log.groupBy(big(S.shard(F.col("request_id"))).alias("shard")).agg(F.count("*").alias("n"))


@query(
    "e08_feature_hash",
    """SELECT event_id, sha256('P' || user_id || ':' || md5(props) || ':' || '{"a":"' || event_type || '","k":"' ||
              json_extract_string(props, '$.k') || '"}') AS feature_hash FROM events""",
)
def _(d):
    meta = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"), F.lit("a"), F.col("event_type"))
    hashed = S.feature_hash(F.concat(F.lit("P"), "user_id"), F.md5("props"), meta)
    return d.table("events").select("event_id", hashed.alias("feature_hash"))


@query(
    "e09_coerce_top_k",
    f"SELECT top_k, count(*) AS n FROM (SELECT {PARAMETERS} FROM parsed WHERE error_message IS NULL) GROUP BY 1",
)
def _(d):
    rows = V.request_parameters(V.parse_events(d.messages).valid)
    return rows.groupBy(big("top_k").alias("top_k")).agg(F.count("*").alias("n"))


@query(
    "e10_coerce_threshold",
    f"SELECT threshold, count(*) AS n FROM (SELECT {PARAMETERS} FROM parsed WHERE error_message IS NULL) GROUP BY 1",
)
def _(d):
    rows = V.request_parameters(V.parse_events(d.messages).valid)
    return rows.groupBy("threshold").agg(F.count("*").alias("n"))


@query(
    "e11_parse_ts",
    """SELECT event_id, strftime(CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts)
              WHEN 1 THEN date_trunc('second', ts) - INTERVAL 7 HOUR ELSE date_trunc('day', ts) - INTERVAL 7 HOUR END,
              '%Y-%m-%d %H:%M:%S') AS parsed_at FROM events""",
)
def _(d):
    text = (
        F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_id") % 3 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
    )
    return d.table("events").select("event_id", stamp(S.parse_ts(text)).alias("parsed_at"))


@query(
    "e12_bucket_keys",
    """SELECT seq, strftime(created_at + INTERVAL 7 HOUR, '%Y-%m-%d') || '#' || current_status AS status_bucket,
              strftime(created_at + INTERVAL 7 HOUR, '%Y-%m-%d') || '#' || username AS username_bucket,
              lower(protein_id) AS protein_bucket FROM status_log""",
)
def _(d):
    keys = S.bucket_keys(F.col("created_at"), F.col("current_status"), F.col("username"), F.col("protein_id"))
    wide = d.status_log.withColumns(keys)
    return wide.select("seq", "status_bucket", "username_bucket", "protein_bucket")


@query(
    "e13_accession",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'A' || p_partkey WHEN 1 THEN split_part(p_name, ' ', 1) ELSE 'tr|' END AS accession
       FROM part""",
)
def _(d):
    header = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit(">sp|A"), "p_partkey", F.lit("|"), "p_name"))
        .when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("> "), "p_name"))
        .otherwise(F.concat(F.lit("tr| "), "p_name"))
    )
    return d.table("part").select("p_partkey", S.accession(header).alias("accession"))


@query(
    "e14_payload_aliases",
    """SELECT event_id,
              CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN value / 2 WHEN 2 THEN 0.0 ELSE value * 2 END AS score,
              CASE event_id % 3 WHEN 0 THEN 'T' || user_id WHEN 1 THEN 'G' || user_id ELSE '' END AS term
       FROM (SELECT event_id, user_id, floor(value) AS value FROM events)""",
)
def _(d):
    v = F.floor("value").cast("double")
    score = (
        F.when(F.col("event_id") % 4 == 0, F.format_string('"score":%.1f', v))
        .when(F.col("event_id") % 4 == 1, F.format_string('"score":"bad","prob":"%.1f"', v / 2))
        .when(F.col("event_id") % 4 == 2, F.lit('"score":null'))
        .otherwise(F.format_string('"p":%.1f,"value":1', v * 2))
    )
    term = (
        F.when(F.col("event_id") % 3 == 0, F.format_string('"term_id":" T%d "', "user_id"))
        .when(F.col("event_id") % 3 == 1, F.format_string('"term_id":"","go_id":"G%d"', "user_id"))
        .otherwise(F.lit('"name":"x"'))
    )
    obj = F.concat(F.lit("{"), score, F.lit(","), term, F.lit("}"))
    rows = d.table("events").select("event_id", obj.alias("obj"))
    return rows.select("event_id", P.score_of(F.col("obj")).alias("score"), P.term_of(F.col("obj")).alias("term"))


@query(
    "e15_map_aspect",
    """SELECT namespace, code, CASE WHEN code IS NULL THEN NULL ELSE code END AS mapped, count(*) AS n FROM (
         SELECT o.namespace, CASE o.term % 4 WHEN 3 THEN NULL ELSE o.aspect END AS code FROM ontology o) GROUP BY 1, 2, 3""",
)
def _(d):
    four = F.col("term") % 4
    given = (
        F.when(four == 0, F.col("namespace"))
        .when(four == 1, F.col("aspect"))
        .when(four == 2, F.when(F.col("aspect") == "MF", "F").when(F.col("aspect") == "BP", "P").otherwise("C"))
        .otherwise("other")
    )
    rows = d.ontology.select("namespace", S.map_aspect(given).alias("code"))
    return rows.groupBy("namespace", "code", F.col("code").alias("mapped")).agg(F.count("*").alias("n"))


@query(
    "e16_confidence_summary",
    """SELECT protein_id, printf('top_terms=%d;max_score=%.6f', count(*), max(score)) AS summary
       FROM scores GROUP BY protein_id""",
)
def _(d):
    per_protein = d.scores.groupBy("protein_id").agg(F.count("*").alias("n"), F.max("score").alias("best"))
    return per_protein.select("protein_id", S.confidence_text(F.col("n"), F.col("best")).alias("summary"))


@query(
    "e16_confidence_sentence",
    """SELECT protein_id, CASE WHEN top_term IS NULL
         THEN printf('CAFA-6 Modal endpoint processed %s with %d amino acids but returned no GO terms.', protein_id, n)
         ELSE printf('CAFA-6 Modal endpoint processed %s with %d amino acids; top GO term is %s with score %.3f.',
                     protein_id, n, top_term, score) END AS sentence
       FROM (SELECT 'P' || protein_id AS protein_id, length(sequence) AS n,
                    CASE WHEN protein_id % 5 <> 0 THEN 'GO:' || (protein_id % 100) END AS top_term,
                    CAST(protein_id % 100 AS DOUBLE) / 100 AS score FROM proteins)""",
)
def _(d):
    pid = F.col("protein_id")
    term = F.when(pid % 5 != 0, F.concat(F.lit("GO:"), pid % 100))
    name = F.concat(F.lit("P"), pid)
    text = S.confidence_sentence(name, F.col("sequence"), term, (pid % 100) / 100.0)
    return d.proteins.select(name.alias("protein_id"), text.alias("sentence"))


@query(
    "e17_batch_label",
    """SELECT request_id, CASE WHEN count(*) = 1 THEN max(protein_id) ELSE 'batch:' || count(*) || '-proteins' END AS label,
              count(*) <> 1 AS is_batch
       FROM request_records GROUP BY request_id""",
)
def _(d):
    sizes = d.request_records.groupBy("request_id").agg(F.count("*").alias("n"), F.max("protein_id").alias("one"))
    label = S.batch_label(F.col("n"), F.col("one"))
    return sizes.select("request_id", label.alias("label"), S.is_batch_label(label).alias("is_batch"))


@query(
    "e18_unique_ids",
    """SELECT position, CASE WHEN rn = 1 THEN protein_id ELSE protein_id || '_' || rn END AS protein_id
       FROM (SELECT *, row_number() OVER (PARTITION BY protein_id ORDER BY position) AS rn FROM inbound)""",
)
def _(d):
    return naming.unique_ids(d.inbound.select("position", "protein_id"), "position")


@query(
    "e19_check_requests",
    """WITH recs AS (SELECT request_id, protein_id AS id, sequence_length,
                 row_number() OVER (PARTITION BY request_id ORDER BY position, protein_id, price, supplier) AS place FROM request_records),
       dup AS (SELECT *, min(place) OVER (PARTITION BY request_id, lower(id)) AS first_place FROM recs),
       bad AS (SELECT request_id, place, CASE WHEN place > first_place THEN 'Duplicate protein ID in FASTA records: ' || id
                 WHEN sequence_length = 13 THEN id || ': Sequence contains unsupported symbols: B.' END AS msg FROM dup),
       per AS (SELECT request_id, count(*) AS n, arg_min(msg, place) FILTER (WHERE msg IS NOT NULL) AS msg FROM bad GROUP BY request_id)
       SELECT o.o_orderkey AS request_id, coalesce(p.n, 0) AS n_records,
         coalesce(p.msg, CASE WHEN p.n IS NULL THEN 'At least one FASTA record is required.' END,
           CASE WHEN p.n > 400 THEN 'A request can include at most 400 FASTA records.' END,
           CASE WHEN o.o_orderstatus = 'P' THEN 'model must be one of: ensemble, esm_mlp, protcnn, bilstm' END,
           CASE WHEN o.o_orderkey % 600 > 500 OR o.o_orderkey % 600 < 1 THEN 'top_k must be between 1 and 500' END) AS error_message
       FROM orders o LEFT JOIN per p ON o.o_orderkey = p.request_id""",
)
def _(d):
    # any sortable value can be a position, so rows need not be numbered
    place = F.struct("position", "protein_id", "price", "supplier")
    records = d.request_records.select(
        "request_id", place.alias("position"), F.col("protein_id").alias("id"),
        F.when(F.col("sequence_length") == 13, "mkb").otherwise("mk l").alias("sequence"),
    )
    heads = d.table("orders").select(
        F.col("o_orderkey").alias("request_id"),
        F.when(F.col("o_orderstatus") == "P", "other").when(F.col("o_orderstatus") == "F", " ").otherwise("ProtCNN").alias("model"),
        (F.col("o_orderkey") % 600).alias("top_k"),
        F.lit(0.5).alias("threshold"),
    )
    return requests.check_requests(heads, records)


@query(
    "e20_lm_text",
    """SELECT protein_id, rtrim(regexp_replace(regexp_replace(sequence, '[UZOB]', 'X', 'g'), '(.)', '\\1 ', 'g')) AS lm
       FROM proteins""",
)
def _(d):
    return d.proteins.select("protein_id", S.lm_text(F.col("sequence")).alias("lm"))


@query(
    "e21_encode_sequence",
    """SELECT protein_id, array_to_string(list_transform(range(1, 33), lambda i:
              CASE WHEN i > length(sequence) THEN 0 ELSE strpos('ACDEFGHIKLMNPQRSTVWY', sequence[i:i]) END), ',') AS codes FROM proteins""",
)
def _(d):
    codes = S.encode_sequence(F.col("sequence"), 32)
    return d.proteins.select("protein_id", F.array_join(codes.cast("array<string>"), ",").alias("codes"))


@query(
    "e22_kmers",
    """SELECT protein_id, kmer, count(*) AS n FROM (
         SELECT protein_id, substr(sequence, CAST(i AS INT), 3) AS kmer
         FROM proteins, LATERAL (SELECT unnest(range(1, greatest(length(sequence) - 1, 1))) AS i)) GROUP BY 1, 2""",
)
def _(d):
    return agg.kmers(d.proteins, "protein_id", "sequence", 3)


_LETTERS = S.STANDARD_LETTERS


@query(
    "e23_aa_composition",
    "SELECT protein_id, "
    + ", ".join(
        f"round((length(sequence) - length(replace(sequence, '{x}', ''))) / nullif(length(sequence), 0), 6) AS r_{x.lower()}"
        for x in _LETTERS
    )
    + " FROM proteins",
)
def _(d):
    wide = d.proteins.select("protein_id", S.aa_composition(F.col("sequence")).alias("m"))
    return wide.select("protein_id", *[r6(F.col("m")[x]).alias(f"r_{x.lower()}") for x in _LETTERS])


def _ratio_sql(letters: str) -> str:
    return f"round(length(regexp_replace(sequence, '[^{letters}]', '', 'g')) / nullif(length(sequence), 0), 6)"


@query(
    "e24_physchem",
    f"""SELECT protein_id, {_ratio_sql(S.HYDROPHOBIC)} AS hydrophobic_ratio, {_ratio_sql(S.POLAR)} AS polar_ratio,
        {_ratio_sql(S.CHARGED)} AS charged_ratio, length(sequence) * 110 AS molecular_weight, length(sequence) AS length FROM proteins""",
)
def _(d):
    wide = d.proteins.select("protein_id", S.physchem(F.col("sequence")).alias("p"))
    ratios = [r6(f"p.{c}").alias(c) for c in ("hydrophobic_ratio", "polar_ratio", "charged_ratio")]
    return wide.select("protein_id", *ratios, "p.molecular_weight", "p.length")


@query(
    "e25_preview",
    "SELECT protein_id, length(sequence) AS length, left(sequence, 60) AS sequence_preview FROM proteins",
)
def _(d):
    return d.proteins.select("protein_id", S.preview(F.col("sequence")).alias("p")).select("protein_id", "p.*")


@query(
    "e26_unescape",
    """SELECT doc_id, replace(replace(CASE WHEN strpos(t, '"') > 0 THEN left(t, strpos(t, '"') - 1) ELSE t END, chr(10), ' '), chr(13), ' ') AS definition
       FROM (SELECT doc_id, replace(text, '\\', '') AS t FROM documents)""",
)
def _(d):
    from seqloom.sources.readers import _unescape

    flat = F.regexp_replace("text", "[\n\r]", " ")
    head = F.substring_index(F.replace(flat, F.lit("\\"), F.lit("")), '"', 1)
    # every letter e is written as an escape, the text ends at the first quote
    coded = F.concat(F.lit('x "'), F.replace(head, F.lit("e"), F.lit("\\e")), F.lit('" tail "more"'))
    return d.table("documents").select("doc_id", _unescape(coded).alias("definition"))


@query(
    "e27_decode_rows",
    """SELECT protein_id, count(*) FILTER (WHERE term % 7 <> 0) AS n_rows,
              round(max(score) FILTER (WHERE term % 7 <> 0), 6) AS best
       FROM scores GROUP BY protein_id""",
)
def _(d):
    row = F.to_json(F.struct(F.col("term").cast("string").alias("go_term"), "score"))
    text = F.when(F.col("term") % 7 == 0, F.concat(F.lit("{"), row)).otherwise(row)
    parsed = d.scores.select("protein_id", P.decode_row(text).alias("row"))
    return parsed.groupBy("protein_id").agg(F.count("row").alias("n_rows"), r6(F.max("row.score")).alias("best"))


@query(
    "e28_terms_of",
    """SELECT protein_id, term // 20 AS message, string_agg(term || '=' || printf('%.2f', score), ',' ORDER BY score DESC, term) AS terms
       FROM scores GROUP BY 1, 2""",
)
def _(d):
    # a message holds 20 terms at most; even ones come as objects with a score, odd ones as bare ids scored by the map
    name = F.col("term").cast("string")
    item = F.when(F.col("term") % 2 == 0, F.to_json(F.struct(name.alias("go_term"), "score"))).otherwise(
        F.concat(F.lit('"'), name, F.lit('"'))
    )
    entry = F.struct(F.col("term"), item.alias("item"), F.concat(F.lit('"'), name, F.lit('":'), F.col("score")).alias("pair"))
    message = F.floor(F.col("term") / 20).alias("message")
    lists = d.scores.groupBy("protein_id", message).agg(F.array_sort(F.collect_list(entry)).alias("x"))
    join = lambda f: F.array_join(F.transform("x", lambda e: e[f]), ",")
    text = F.concat(F.lit('{"top_terms":['), join("item"), F.lit('],"score_map":{'), join("pair"), F.lit("}}"))
    terms = lists.select("protein_id", "message", P.terms_of(text).alias("t"))
    shown = F.transform("t", lambda t: F.format_string("%s=%.2f", t["term_id"], t["score"]))
    return terms.select("protein_id", "message", F.array_join(shown, ",").alias("terms"))


@query(
    "e29_score_map",
    """WITH rows AS (SELECT l_orderkey AS protein_id, l_partkey % 5 AS term, l_quantity / 50 AS score,
                 row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice, l_suppkey) AS rn FROM lineitem),
       per AS (SELECT protein_id, term, min(rn) AS first_rn, arg_max(score, rn) AS score FROM rows GROUP BY 1, 2)
       SELECT p.protein_id, CAST(p.term AS VARCHAR) AS go_term, l_linenumber AS first_line, round(score, 6) AS score
       FROM per p JOIN (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_extendedprice, l_suppkey) AS rn FROM lineitem) ON l_orderkey = protein_id AND rn = first_rn""",
)
def _(d):
    order = ["l_linenumber", "l_partkey", "l_extendedprice", "l_suppkey"]
    rows = d.table("lineitem").select(
        F.col("l_orderkey").alias("protein_id"), (F.col("l_partkey") % 5).cast("string").alias("go_term"),
        (F.col("l_quantity") / 50).alias("score"), *order,
    )
    scored = P.score_rows(rows, ["protein_id"], "go_term", "score", order)
    return scored.select("protein_id", "go_term", F.col("first_place.l_linenumber").alias("first_line"), r6("score").alias("score"))


@query(
    "e30_resolve_columns",
    """SELECT method, namespace, round(max(f), 6) AS f, round(max(f_w), 6) AS f_w, round(min(s), 6) AS s,
              count(*) AS n FROM evaluations GROUP BY 1, 2""",
)
def _(d):
    raw = d.evaluations.select(
        F.col("method").alias("FileName"), F.col("namespace").alias("NS"), F.col("threshold").alias("tau"),
        F.col("f").alias("Fmax"), F.col("f_w").alias("my_weighted_f"), F.col("s").alias("S"),
    )
    found = P.resolve_columns(raw)
    return found.groupBy("method", "namespace").agg(
        r6(F.max("f")).alias("f"), r6(F.max("f_w")).alias("f_w"), r6(F.min("s")).alias("s"), F.count("*").alias("n")
    )


@query(
    "e31_clip_scores",
    """SELECT l_orderkey AS protein_id, l_partkey AS term, CAST(l_linenumber AS BIGINT) AS line, round(least(l_quantity / 30 - 0.5, 1.0), 6) AS score
       FROM lineitem WHERE l_quantity / 30 - 0.5 > 0""",
)
def _(d):
    raw = d.table("lineitem").select(
        F.col("l_orderkey").alias("protein_id"), F.col("l_partkey").alias("term"), big("l_linenumber").alias("line"),
        S.clip_score(F.col("l_quantity") / 30 - 0.5).alias("score"),
    )
    return raw.filter("score > 0").withColumn("score", r6("score"))
