"""Registered queries: joins, graph operators and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from seqloom.operators import agg, dedupe, graph, joins, prep
from seqloom.plans.domain import big, r6, stamp
from seqloom.plans.registry import query

FMT = "'%Y-%m-%d %H:%M:%S'"


@query(
    "j01_annotate_sequences",
    """SELECT p.protein_id, length(p.sequence) AS letters, a.term, a.aspect, t.taxon, round(i.ia, 6) AS ia
       FROM proteins p LEFT JOIN annotations a ON a.protein_id = p.protein_id
       LEFT JOIN taxonomy t ON t.protein_id = p.protein_id LEFT JOIN ia i ON i.term = a.term""",
)
def _(d):
    sequences = d.proteins.select("protein_id", big(F.length("sequence")).alias("letters"))
    rows = joins.annotate_sequences(sequences, d.annotations, d.taxonomy, d.ia)
    return rows.select("protein_id", "letters", "term", "aspect", "taxon", r6("ia").alias("ia"))


@query(
    "j02_annotated_ids",
    "SELECT DISTINCT protein_id FROM proteins WHERE protein_id IN (SELECT protein_id FROM annotations)",
)
def _(d):
    return joins.annotated_ids(d.proteins, d.annotations)


@query(
    "f04_restrict",
    """SELECT protein_id, term, aspect FROM annotations WHERE protein_id IN (SELECT protein_id FROM proteins)
       AND term IN (SELECT term FROM selected)""",
)
def _(d):
    return joins.restrict(d.annotations, d.proteins, prep.select_terms(d.annotations)).select("protein_id", "term", "aspect")


@query(
    "j03_covered_share",
    """SELECT count(*) FILTER (WHERE term IN (SELECT term FROM selected)) AS covered_rows, count(*) AS all_rows,
              round(count(*) FILTER (WHERE term IN (SELECT term FROM selected)) / count(*), 6) AS share FROM annotations""",
)
def _(d):
    out = joins.covered_share(d.annotations, prep.select_terms(d.annotations))
    return out.select("covered_rows", "all_rows", r6("share").alias("share"))


@query(
    "j04_overlapping_ids",
    """SELECT protein_id, min(s) AS first_split, max(s) AS last_split FROM
         (SELECT l_orderkey AS protein_id, CASE WHEN l_linenumber < 4 THEN 'train' ELSE 'valid' END AS s FROM lineitem)
       GROUP BY 1 HAVING count(DISTINCT s) > 1""",
)
def _(d):
    side = F.when(F.col("l_linenumber") < 4, "train").otherwise("valid")
    rows = d.table("lineitem").select(F.col("l_orderkey").alias("protein_id"), side.alias("split"))
    return joins.overlapping_ids(rows)


@query(
    "j04_invalid_ids",
    "SELECT o_orderkey AS protein_id FROM orders WHERE o_orderkey NOT IN (SELECT protein_id FROM annotations)",
)
def _(d):
    return joins.invalid_ids(d.scored_proteins, d.annotations)


@query(
    "j05_with_ia",
    """SELECT a.protein_id, a.term, round(coalesce(i.ia, 1.0), 6) AS ia FROM annotations a LEFT JOIN ia i ON i.term = a.term""",
)
def _(d):
    return joins.with_ia(d.annotations, d.ia).select("protein_id", "term", r6("ia").alias("ia"))


ASPECTS_SQL = """voted AS (SELECT term, arg_min(aspect, (-n, aspect)) AS aspect FROM
      (SELECT term, aspect, count(*) AS n FROM annotations GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "j06_term_aspects",
    f"""WITH {ASPECTS_SQL}
        SELECT coalesce(v.term, o.term) AS term, coalesce(v.aspect, o.aspect) AS aspect
        FROM voted v FULL OUTER JOIN ontology o ON o.term = v.term""",
)
def _(d):
    return joins.term_aspects(d.annotations, d.ontology)


@query(
    "j07_attach_results",
    """SELECT i.position, coalesce(p.n, 0) AS n_terms, round(coalesce(p.best, 0.0), 6) AS max_score, p.first_term
       FROM inbound i LEFT JOIN (SELECT 'P' || protein_id AS pid, count(*) AS n, max(score) AS best,
         arg_min(CAST(term AS VARCHAR), (-score, term)) AS first_term
         FROM scores GROUP BY 1) p ON p.pid = i.protein_id""",
)
def _(d):
    none = F.lit(None).cast("string")
    predictions = d.scores.select(
        F.concat(F.lit("P"), "protein_id").alias("protein_id"), F.lit("ensemble").alias("model"),
        F.col("term").cast("string").alias("go_term"), "score", none.alias("aspect"), none.alias("name"),
        F.struct(-F.col("score"), F.col("term")).alias("rank"),
    )
    rows = joins.attach_summary(d.inbound, predictions)
    return rows.select("position", "n_terms", r6(F.col("max_score")).alias("max_score"), "first_term")


@query(
    "j07_attached_rows",
    """SELECT i.position, CAST(s.term AS VARCHAR) AS go_term, round(coalesce(s.score, 0.0), 6) AS score
       FROM inbound i LEFT JOIN scores s ON 'P' || s.protein_id = i.protein_id""",
)
def _(d):
    none = F.lit(None).cast("string")
    predictions = d.scores.select(
        F.concat(F.lit("P"), "protein_id").alias("protein_id"), F.lit("ensemble").alias("model"),
        F.col("term").cast("string").alias("go_term"), "score", none.alias("aspect"), none.alias("name"),
        F.struct(-F.col("score"), F.col("term")).alias("rank"),
    )
    rows = joins.attach_results(d.inbound.select("position", "protein_id"), predictions)
    return rows.select("position", "go_term", r6(F.col("score")).alias("score"))


@query(
    "j08_enrich_terms",
    """SELECT a.protein_id, a.term AS term_id, CASE WHEN a.term % 2 = 0 THEN 'own' ELSE o.name END AS term_name, o.aspect AS ontology,
              o.definition FROM annotations a LEFT JOIN ontology o ON o.term = a.term""",
)
def _(d):
    none = F.lit(None).cast("string")
    bare = d.annotations.select(
        "protein_id", F.col("term").alias("term_id"), F.when(F.col("term") % 2 == 0, "own").alias("term_name"),
        none.alias("ontology"), F.lit("").alias("definition"),
    )
    return joins.enrich_terms(bare, d.ontology)


@query(
    "j09_first_source",
    """WITH a AS (SELECT protein_id AS k, request_id, seq FROM status_log),
       b AS (SELECT lower(protein_id) AS k, request_id, seq FROM predictions)
       SELECT upper(k) AS protein_id, request_id, seq, CAST(1 AS BIGINT) AS source_rank FROM a
       UNION ALL SELECT upper(k), request_id, seq, 2 FROM b WHERE upper(k) NOT IN (SELECT k FROM a)""",
)
def _(d):
    links = d.status_log.select("protein_id", "request_id", "seq")
    buckets = d.predictions.select(F.upper("protein_id").alias("protein_id"), "request_id", "seq")
    rows = joins.first_source([links, buckets], ["protein_id"])
    return rows.select("protein_id", "request_id", "seq", big("source_rank").alias("source_rank"))


@query(
    "j10_request_protein_links",
    """SELECT o_orderkey AS request_id, 'P' || l_partkey AS protein_id, CAST(l_quantity AS BIGINT) AS sequence_length
       FROM orders JOIN lineitem ON l_orderkey = o_orderkey
       UNION ALL SELECT o_orderkey, 'single' || o_custkey, 7 FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def _(d):
    records = d.table("lineitem").select(
        F.col("l_orderkey").alias("request_id"), F.concat(F.lit(" P"), "l_partkey").alias("protein_id"),
        F.col("l_quantity").cast("int").alias("sequence_length"),
    )
    events = d.table("orders").select(
        F.col("o_orderkey").alias("request_id"), F.concat(F.lit("single"), "o_custkey").alias("protein_id"),
        F.lit(7).alias("sequence_length"),
    )
    rows = joins.link_records(events, records)
    return rows.select("request_id", "protein_id", big("sequence_length").alias("sequence_length"))


@query(
    "j11_reconcile_status",
    """SELECT s.seq, s.request_id, s.current_status FROM status_log s JOIN latest_log l ON l.request_id = s.request_id
       WHERE s.current_status = l.current_status""",
)
def _(d):
    rows = joins.reconcile_status(d.status_log, dedupe.latest_requests(d.status_log))
    return rows.select("seq", "request_id", "current_status")


@query(
    "j12_count_in_minutes",
    f"""SELECT strftime(m, {FMT}) AS window_start, count(s.request_id) AS metric_value FROM
          (SELECT DISTINCT date_trunc('minute', ts) AS m FROM events) LEFT JOIN status_log s
          ON s.created_at >= m AND s.created_at < m + INTERVAL 1 MINUTE GROUP BY m""",
)
def _(d):
    minutes = d.table("events").select(F.date_trunc("minute", "ts").alias("window_start")).distinct()
    rows = joins.count_in_minutes(d.status_log, minutes)
    return rows.select(stamp("window_start").alias("window_start"), "metric_value")


WINDOWS = "(SELECT event_id, ts AS window_start, ts + to_seconds(5 + event_id % 600) AS window_end FROM events)"


def _windows(d):
    """A window from each event on, of 5 seconds to 10 minutes."""
    seconds = 5 + F.col("event_id") % 600
    end = F.timestamp_add("SECOND", seconds.cast("int"), "ts")
    return d.table("events").select("event_id", F.col("ts").alias("window_start"), end.alias("window_end"))


@query(
    "j12_count_in_windows",
    f"""SELECT event_id, count(s.request_id) AS metric_value FROM {WINDOWS} LEFT JOIN status_log s
          ON s.created_at >= window_start AND s.created_at < window_end GROUP BY 1""",
)
def _(d):
    return joins.count_in_windows(d.status_log, _windows(d)).select("event_id", "metric_value")


@query(
    "j12_rows_in_windows",
    f"""SELECT s.current_status, event_id % 100 AS slot, count(*) AS n, count(DISTINCT event_id) AS windows FROM {WINDOWS}
          JOIN status_log s ON s.created_at >= window_start AND s.created_at < window_end GROUP BY 1, 2""",
)
def _(d):
    rows = joins.rows_in_windows(d.status_log, _windows(d))
    slot = F.col("event_id") % 100
    return rows.groupBy("current_status", slot.alias("slot")).agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("windows")
    )


@query(
    "j13_selected_edges",
    "SELECT child, parent FROM edges WHERE child IN (SELECT term FROM selected) AND parent IN (SELECT term FROM selected)",
)
def _(d):
    return joins.selected_edges(d.edges, prep.select_terms(d.annotations)).select("child", "parent")


@query(
    "j14_match_proteins",
    """SELECT p.seq, p.protein_id, l.n FROM predictions p JOIN
         (SELECT lower(protein_id) AS k, count(*) AS n FROM status_log GROUP BY 1) l ON l.k = lower(p.protein_id)""",
)
def _(d):
    counts = d.status_log.groupBy("protein_id").agg(F.count("*").alias("n"))
    return joins.match_proteins(d.predictions, counts).select("seq", "protein_id", "n")


@query(
    "j15_per_threshold",
    """SELECT t AS threshold, count(*) AS n FROM scores, (SELECT unnest([0.1, 0.25, 0.5, 0.75, 0.9]::DOUBLE[]) AS t) WHERE score >= t GROUP BY 1""",
)
def _(d):
    rows = joins.per_threshold(d.scores, [0.1, 0.25, 0.5, 0.75, 0.9])
    return rows.groupBy("threshold").agg(F.count("*").alias("n"))


@query(
    "j16_visible_predictions",
    """SELECT seq, request_id FROM predictions WHERE request_id IN (SELECT request_id FROM latest_log WHERE current_status = 'completed')""",
)
def _(d):
    visible = dedupe.latest_requests(d.status_log).filter("current_status = 'completed'")
    return joins.visible_predictions(d.predictions, visible).select("seq", "request_id")


@query(
    "j17_compare_results",
    """SELECT namespace, round(max(f_w) FILTER (WHERE result_set = 'original'), 6) AS original,
              round(max(f_w) FILTER (WHERE result_set = 'regenerated'), 6) AS regenerated,
              round(max(f_w) FILTER (WHERE result_set = 'regenerated') - max(f_w) FILTER (WHERE result_set = 'original'), 6) AS difference
       FROM evaluations GROUP BY 1""",
)
def _(d):
    best = lambda rows: rows.groupBy("namespace").agg(F.max("f_w").alias("f_w"))
    original = best(d.evaluations.filter("result_set = 'original'"))
    regenerated = best(d.evaluations.filter("result_set = 'regenerated'"))
    out = joins.compare_results(original, regenerated, "f_w")
    return out.select("namespace", *[r6(c).alias(c) for c in ("original", "regenerated", "difference")])


# --- graph -------------------------------------------------------------------------------------


@query("g01_ancestors", "SELECT term, ancestor FROM closure")
def _(d):
    return graph.ancestors(d.edges)


@query(
    "g02_propagate_labels",
    """SELECT protein_id, count(*) AS n_labels, CAST(sum(term) AS BIGINT) AS term_sum, CAST(sum(term * term) AS BIGINT) AS square_sum
       FROM graph_labels GROUP BY 1""",
)
def _(d):
    rows = graph.propagate_labels(d.annotations, graph.ancestors(d.edges), prep.select_terms(d.annotations))
    return rows.groupBy("protein_id").agg(
        F.count("*").alias("n_labels"), F.sum("term").alias("term_sum"), F.sum(F.col("term") * F.col("term")).alias("square_sum")
    )


PATHS = """inner_edges AS (SELECT child, parent FROM edges WHERE child IN (SELECT term FROM selected) AND parent IN (SELECT term FROM selected)),
    reach AS (SELECT child AS term, parent AS target FROM inner_edges UNION SELECT r.term, e.parent FROM reach r JOIN inner_edges e ON e.child = r.target),
    paths AS (SELECT term, target FROM reach UNION ALL SELECT term, term FROM selected),
    lifted AS (SELECT protein_id, target AS term, max(score) AS score FROM scores JOIN paths USING (term) GROUP BY 1, 2)"""


@query(
    "g03_propagate_scores",
    f"""WITH RECURSIVE {PATHS} SELECT protein_id, count(*) AS n_terms, CAST(sum(term) AS BIGINT) AS term_sum,
        round(sum(score), 4) AS score_sum, round(sum(score * term), 2) AS weighted_sum FROM lifted GROUP BY 1""",
)
def _(d):
    paths = graph.score_paths(d.edges, prep.select_terms(d.annotations))
    rows = graph.propagate_scores(d.scores, paths)
    return rows.groupBy("protein_id").agg(
        F.count("*").alias("n_terms"), F.sum("term").alias("term_sum"), F.round(F.sum("score"), 4).alias("score_sum"),
        F.round(F.sum(F.col("score") * F.col("term")), 2).alias("weighted_sum"),
    )


@query(
    "g04_degrees",
    """WITH i AS (SELECT child, parent FROM edges WHERE child IN (SELECT term FROM selected) AND parent IN (SELECT term FROM selected))
       SELECT term, (SELECT count(*) FROM i WHERE i.child = s.term) AS n_parents, (SELECT count(*) FROM i WHERE i.parent = s.term) AS n_children
       FROM selected s""",
)
def _(d):
    return graph.degrees(d.edges, prep.select_terms(d.annotations))


VIOLATIONS = """SELECT '{name}' AS variant, coalesce(sum(CASE WHEN gap > 1e-8 THEN 1 ELSE 0 END), 0)::BIGINT AS violations,
    round(coalesce(sum(CASE WHEN gap > 1e-8 THEN 1 ELSE 0 END), 0) / (SELECT count(*) FROM scored_proteins) / (SELECT count(*) FROM inner_edges), 9) AS rate,
    round(coalesce(sum(greatest(gap, 0)), 0) / (SELECT count(*) FROM scored_proteins) / (SELECT count(*) FROM inner_edges), 9) AS mean_excess
    FROM (SELECT c.score - coalesce(p.score, 0) AS gap FROM {table} c JOIN inner_edges e ON e.child = c.term
          LEFT JOIN {table} p ON p.protein_id = c.protein_id AND p.term = e.parent)"""


@query(
    "g05_hierarchy_violations",
    f"WITH RECURSIVE {PATHS} {VIOLATIONS.format(name='raw', table='scores')} UNION ALL {VIOLATIONS.format(name='propagated', table='lifted')}",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    edges = joins.selected_edges(d.edges, terms)
    lifted = graph.propagate_scores(d.scores, graph.score_paths(d.edges, terms))
    out = None
    for name, scores in (("raw", d.scores), ("propagated", lifted)):
        row = graph.hierarchy_violations(scores, edges, d.scored_proteins).select(
            F.lit(name).alias("variant"), "violations",
            F.round("hierarchy_violation_rate", 9).alias("rate"), F.round("hierarchy_violation_mean", 9).alias("mean_excess"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "g06_label_stats",
    """WITH u AS (SELECT DISTINCT protein_id FROM annotations WHERE term IN (SELECT term FROM selected)), n AS (SELECT count(*) AS n FROM u)
       SELECT 'raw_selected' AS setting, (SELECT count(*) FROM (SELECT DISTINCT protein_id, term FROM annotations WHERE term IN (SELECT term FROM selected))) AS positive_labels,
              round((SELECT count(*) FROM (SELECT DISTINCT protein_id, term FROM annotations WHERE term IN (SELECT term FROM selected))) / (SELECT n FROM n), 6) AS avg_labels
       UNION ALL SELECT 'graph_propagated', (SELECT count(*) FROM graph_labels WHERE protein_id IN (SELECT protein_id FROM u)),
              round((SELECT count(*) FROM graph_labels WHERE protein_id IN (SELECT protein_id FROM u)) / (SELECT n FROM n), 6)""",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    proteins = prep.usable(d.annotations, terms)
    raw = joins.restrict(d.annotations, terms=terms).select("protein_id", "term").distinct()
    lifted = graph.propagate_labels(d.annotations, graph.ancestors(d.edges), terms)
    out = graph.label_stats({"raw_selected": raw, "graph_propagated": lifted}, proteins)
    return out.select("setting", "positive_labels", r6("avg_labels_per_protein").alias("avg_labels"))


# --- set operations ----------------------------------------------------------------------------


@query(
    "u01_union_all",
    """SELECT protein_id, term, aspect, CAST(NULL AS DOUBLE) AS score FROM annotations
       UNION ALL SELECT protein_id, term, NULL, round(score, 6) FROM scores""",
)
def _(d):
    both = joins.union_all([d.annotations, d.scores])
    return both.select("protein_id", "term", "aspect", r6("score").alias("score"))


@query(
    "u02_stored_and_live",
    """SELECT request_id, current_status, seq FROM (SELECT * FROM status_log WHERE seq % 2 = 0 UNION ALL SELECT * FROM status_log WHERE seq % 2 = 1)
       QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY updated_at DESC, seq DESC) = 1""",
)
def _(d):
    stored = d.status_log.filter("seq % 2 = 0").drop("error_message")
    live = d.status_log.filter("seq % 2 = 1")
    return dedupe.latest_requests(joins.union_all([stored, live])).select("request_id", "current_status", "seq")


def _member_sets(d):
    members = lambda flag: agg.sets_by(
        d.table("lineitem").filter(F.col("l_returnflag") == flag).withColumnRenamed("l_orderkey", "protein_id"), "protein_id", "l_partkey"
    )
    return joins.set_tables(members("R"), members("N"))


def _sets_sql(word: str) -> str:
    side = "SELECT DISTINCT l_orderkey AS protein_id, l_partkey AS member FROM lineitem WHERE l_returnflag = "
    return f"{side}'R' {word} {side}'N'"


@query("u03_intersection", _sets_sql("INTERSECT"))
def _(d):
    return _member_sets(d)["both"]


@query("u04_union_of_sets", _sets_sql("UNION"))
def _(d):
    return _member_sets(d)["either"]


@query("u05_difference", _sets_sql("EXCEPT"))
def _(d):
    return _member_sets(d)["only_left"]
