"""Registered queries of this package, and the checking SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


@query(
    "op9_exact_dedup",
    """
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
)
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.stream_dedup import exact_dedup

    judged = exact_dedup(table(spark, folder, "documents"))
    return judged.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


@query("op10_near_groups")
def op10_near_groups(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.odd_sketch import near_groups

    return near_groups(table(spark, folder, "documents"))


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents"))


def remainder(divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(divisor))


def toxicity_model(spark: SparkSession, folder: str):
    """Fitted on a bounded sample of the labelled rows that are not held out."""
    from seqloom.llm import toxicity as tox

    texts, toxic, share = tox.training_rows(table(spark, folder, "documents"), table(spark, folder, "labels"), remainder(5) != 0)
    return tox.fit(texts, toxic, share)


@query("op3_toxicity")
def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.toxicity import score_documents

    scored = score_documents(table(spark, folder, "documents"), toxicity_model(spark, folder), keep=["doc_id"])
    return scored.select(
        "doc_id",
        (remainder(5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op7_decontaminate")
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.decontaminate import find_leaks

    leaks = find_leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return leaks.select(F.when(F.col("key") >= 0, F.col("key")).alias("doc_id"), "item_id", "start", "m", "similarity")


@query(
    "op4_url_rules",
    r"""
    WITH rules(rule, rule_verdict) AS (VALUES ('org/', 'allow'), ('example.org/es/', 'block'),
      ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')),
    parts AS (SELECT page_id, url, regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', ['host', 'path'], 's') AS p FROM pages),
    split AS (SELECT page_id, translate(p.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, p.path AS path FROM parts),
    keyed AS (SELECT row_number() OVER () AS k, * FROM split),
    fits AS (SELECT k, max(length(rule)) AS longest FROM keyed, rules
      WHERE ('.' || host) LIKE ('%.' || split_part(rule, '/', 1))
        AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1)) GROUP BY k)
    SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict
    FROM keyed LEFT JOIN fits USING (k) LEFT JOIN rules ON length(rule) = longest
      AND ('.' || host) LIKE ('%.' || split_part(rule, '/', 1))
      AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))
    """,
)
def op4_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.url_rules import judge, rule_table

    judged = judge(table(spark, folder, "pages").select("page_id", "url"), rule_table(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op6_language")
def op6_language(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm import language

    docs = table(spark, folder, "documents")
    model = language.fit(*language.training_rows(docs, F.col("doc_id").isNotNull() & (remainder(4) != 2)))
    found = language.identify(docs, model, keep=["doc_id"])
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", F.col("_score").alias("score"))


@query("op2_pii")
def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.pii import BASE, scan

    found = scan(table(spark, folder, "documents"), keep=["doc_id"])
    joined = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    base = f"filter(_spans, s -> s.kind IN {BASE})"
    counts = [F.expr(f"CAST(size(filter(_spans, s -> s.kind = '{k}')) AS long)").alias(f"n_{k}") for k in BASE]
    return found.select(
        "doc_id", *counts, F.sha2(F.expr(joined.format(base)), 256).alias("base_sha256"), F.expr(joined.format("_spans")).alias("spans")
    )


@query("op1_licences")
def op1_licences(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.licences import corpus_files, scan

    return scan(corpus_files(table(spark, folder, "documents"), table(spark, folder, "pages")))


@query("op8_token_rollup")
def op8_token_rollup(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.token_rollup import corpus_rollup

    return corpus_rollup(table(spark, folder, "documents"))


@query("op11_bpe_trie")
def op11_bpe_trie(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.bpe_trie import encode_documents

    coded = encode_documents(table(spark, folder, "documents"), keep=["doc_id"])
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op12_hard_negatives",
    """
    WITH r AS (SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.uid AS anchor, a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, r.uid, list_inner_product(a.v, r.v)::BIGINT AS score
      FROM r AS a, r WHERE a.vec_id % 100 = 0 AND a.uid <> r.uid),
    p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
    SELECT p.anchor_id, p.vec_id AS positive_id,
      row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY s.score DESC, s.vec_id)::INT AS rank,
      s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
    QUALIFY row_number() OVER (PARTITION BY p.anchor, p.uid ORDER BY s.score DESC, s.vec_id) <= 10
    """,
)
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.hard_negatives import mine

    return mine(table(spark, folder, "embeddings"))


@query("op13_spelling_variants")
def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    from seqloom.llm.spelling import group_variants, word_counts

    return group_variants(word_counts(table(spark, folder, "documents")))
