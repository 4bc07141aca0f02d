"""Registered queries: label preparation, scoring, ensembles, metrics and evaluation."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from seqloom.operators import evaluate, graph, joins, metrics, prep, scoring
from seqloom.plans.domain import big, r4, r6
from seqloom.plans.q_relations import PATHS
from seqloom.plans.registry import query

GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
WEIGHTS = {"esm_mlp": 0.5, "protcnn": 0.3, "bilstm": 0.2}


# --- ranking -----------------------------------------------------------------------------------


@query(
    "w01_top_k",
    """SELECT protein_id, term, round(score, 6) AS score FROM (SELECT * FROM scores
         QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY score DESC, term) <= 3) WHERE score >= 0.4""",
)
def _(d):
    return scoring.top_k(d.scores, 3, 0.4)


@query(
    "w02_export_top_k",
    """SELECT protein_id, term, round(least(score, 1.0), 6) AS score FROM scores WHERE score > 0
       QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY score DESC, term) <= 1500""",
)
def _(d):
    return scoring.export_top_k(d.scores).withColumn("score", r6("score"))


@query(
    "w07_report_order",
    """SELECT namespace, method, round(max(f_w), 6) AS f_w, round(min(s), 6) AS s FROM evaluations GROUP BY 1, 2 ORDER BY namespace, f_w DESC, method""",
)
def _(d):
    rows = d.evaluations.groupBy("namespace", "method").agg(r6(F.max("f_w")).alias("f_w"), r6(F.min("s")).alias("s"))
    return rows.orderBy(F.asc("namespace"), F.desc("f_w"), F.asc("method"))


@query(
    "w10_inspect_terms",
    """WITH top AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY score DESC, term) <= 20),
       i AS (SELECT child, count(*) AS n FROM edges WHERE child IN (SELECT term FROM selected) AND parent IN (SELECT term FROM selected) GROUP BY 1)
       SELECT t.protein_id, t.term, round(t.score, 6) AS score, coalesce(s.frequency, 0) AS frequency, round(coalesce(ia.ia, 1.0), 6) AS ia,
              coalesce(i.n, 0) AS n_parents
       FROM top t LEFT JOIN selected s ON s.term = t.term LEFT JOIN ia ON ia.term = t.term LEFT JOIN i ON i.child = t.term""",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    rows = scoring.inspect_terms(d.scores, terms, d.ia, graph.degrees(d.edges, terms))
    return rows.withColumn("ia", r6("ia"))


# --- label preparation -------------------------------------------------------------------------


@query("m01_select_terms", "SELECT term, frequency, term_index FROM selected")
def _(d):
    return prep.select_terms(d.annotations)


@query(
    "m02_usable",
    "SELECT DISTINCT protein_id FROM annotations WHERE term IN (SELECT term FROM selected) AND protein_id IN (SELECT protein_id FROM proteins)",
)
def _(d):
    return prep.usable(d.annotations, prep.select_terms(d.annotations), d.proteins)


@query("m03_strata", "SELECT protein_id, stratum FROM strata")
def _(d):
    return prep.strata(d.annotations)


@query("m04_split", "SELECT protein_id, stratum, split FROM splits")
def _(d):
    return prep.split(prep.strata(d.annotations))


@query("m05_labels", "SELECT protein_id, term_index FROM label_pairs")
def _(d):
    return prep.labels(d.annotations, prep.select_terms(d.annotations))


@query(
    "a14_split_summary",
    """WITH p AS (SELECT a.protein_id, count(DISTINCT a.term) AS nf, count(DISTINCT s.term) AS ns, max((aspect = 'MF')::INT) AS mf,
              max((aspect = 'BP')::INT) AS bp, max((aspect = 'CC')::INT) AS cc
              FROM annotations a LEFT JOIN selected s ON s.term = a.term GROUP BY 1)
       SELECT split, count(*) AS proteins, round(count(*) / (SELECT count(*) FROM splits), 6) AS protein_ratio, round(avg(nf), 6) AS avg_full_terms,
              round(avg(ns), 6) AS avg_selected_terms, CAST(sum(mf) AS BIGINT) AS proteins_with_mf, CAST(sum(bp) AS BIGINT) AS proteins_with_bp,
              CAST(sum(cc) AS BIGINT) AS proteins_with_cc, CAST(median(ns) AS DOUBLE) AS median_selected
       FROM splits JOIN p USING (protein_id) GROUP BY 1""",
)
def _(d):
    rows = prep.split_summary(prep.split(prep.strata(d.annotations)), d.annotations, prep.select_terms(d.annotations))
    return rows.select(
        "split", "proteins", *[r6(c).alias(c) for c in ("protein_ratio", "avg_full_terms", "avg_selected_terms")],
        *[F.col(f"proteins_with_{a}").alias(f"proteins_with_{a.lower()}") for a in ("MF", "BP", "CC")],
        F.col("median_selected_terms").alias("median_selected"),
    )


@query(
    "a15_label_density",
    """SELECT split, count(*) AS positive_labels, round(count(*) / (n * (SELECT count(*) FROM selected)), 9) AS density,
              round(count(DISTINCT term_index) / (SELECT count(*) FROM selected), 6) AS term_coverage
       FROM label_pairs JOIN (SELECT *, count(*) OVER (PARTITION BY split) AS n FROM splits) USING (protein_id) GROUP BY split, n""",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    rows = prep.label_density(prep.labels(d.annotations, terms), prep.split(prep.strata(d.annotations)), terms)
    return rows.select("split", "positive_labels", F.round("density", 9).alias("density"), r6("term_coverage").alias("term_coverage"))


@query(
    "a35_pos_weight",
    """SELECT term_index, n AS positives, round(least(greatest(sqrt(((SELECT count(DISTINCT protein_id) FROM annotations) - n) / greatest(n, 1.0)), 1.0), 30.0), 6) AS pos_weight
       FROM (SELECT term_index, count(*) AS n FROM label_pairs GROUP BY 1)""",
)
def _(d):
    n = metrics.count_of(d.annotations, "protein_id")
    counts = prep.labels(d.annotations, prep.select_terms(d.annotations)).groupBy("term_index").agg(F.count("*").alias("positives"))
    return counts.withColumn("pos_weight", r6(prep.pos_weight(F.col("positives"), n)))


IA_WEIGHTS = """iw AS (SELECT s.term, s.term_index, coalesce(ia.ia, 1.0) AS ia, pow(greatest(coalesce(ia.ia, 1.0), 1e-6), 0.5) AS p
    FROM selected s LEFT JOIN ia ON ia.term = s.term)"""


@query(
    "a36_ia_weight",
    f"""WITH {IA_WEIGHTS} SELECT term, round(least(greatest(p / (SELECT avg(p) FROM iw), 0.25), 8.0), 6) AS ia_loss_weight FROM iw""",
)
def _(d):
    terms = joins.with_ia(prep.select_terms(d.annotations), d.ia)
    return prep.ia_weight(terms).select("term", r6("ia_loss_weight").alias("ia_loss_weight"))


@query(
    "a37_term_weights",
    f"""WITH {IA_WEIGHTS}, i AS (SELECT child, parent FROM edges WHERE child IN (SELECT term FROM selected) AND parent IN (SELECT term FROM selected)),
        up AS (SELECT child AS term, count(*) AS n FROM i GROUP BY 1), dn AS (SELECT parent AS term, count(*) AS n FROM i GROUP BY 1),
        c AS (SELECT term_index, count(*) AS n FROM label_pairs GROUP BY 1)
        SELECT iw.term, iw.term_index, o.name, o.aspect, coalesce(c.n, 0) AS positives,
          round(least(greatest(sqrt(((SELECT count(*) FROM scored_proteins) - coalesce(c.n, 0)) / greatest(coalesce(c.n, 0), 1.0)), 1.0), 30.0), 6) AS pos_weight,
          round(least(greatest(p / (SELECT avg(p) FROM iw), 0.25), 8.0), 6) AS ia_loss_weight, coalesce(up.n, 0) AS n_parents, coalesce(dn.n, 0) AS n_children
        FROM iw LEFT JOIN ontology o ON o.term = iw.term LEFT JOIN c ON c.term_index = iw.term_index
        LEFT JOIN up ON up.term = iw.term LEFT JOIN dn ON dn.term = iw.term""",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    rows = prep.term_weights(terms, prep.labels(d.annotations, terms), d.scored_proteins, d.ia, d.edges, d.ontology)
    return rows.select(
        "term", "term_index", "name", "aspect", "positives", r6("pos_weight").alias("pos_weight"),
        r6("ia_loss_weight").alias("ia_loss_weight"), "n_parents", "n_children",
    )


@query(
    "m18_verify_split",
    """WITH m AS (SELECT protein_id, CASE WHEN protein_id % 50 = 0 THEN 'moved' ELSE split END AS split FROM splits)
       SELECT protein_id, split, 'left' AS side FROM splits WHERE protein_id % 50 = 0
       UNION ALL SELECT protein_id, split, 'right' FROM m WHERE protein_id % 50 = 0""",
)
def _(d):
    split = prep.split(prep.strata(d.annotations))
    moved = split.withColumn("split", F.when(F.col("protein_id") % 50 == 0, "moved").otherwise(F.col("split")))
    return prep.verify_split(split, moved)


# --- scoring and ensembles ---------------------------------------------------------------------


def _linear(frame: pd.DataFrame) -> pd.DataFrame:
    """Fixed linear scorer: alternating sum of the vector; batches holding vector 13 fail."""
    if (frame["vec_id"] == 13).any():
        raise ValueError("bad vector")
    signs = [1.0 if i % 2 == 0 else -1.0 for i in range(64)]
    values = [float(sum(s * float(x) for s, x in zip(signs, v, strict=True))) for v in frame["embedding"]]
    return pd.DataFrame({"vec_id": frame["vec_id"], "score": values})


@query(
    "m06_score",
    """SELECT vec_id, round(list_sum(list_transform(range(1, 65), lambda i: CASE WHEN i % 2 = 1 THEN embedding[i]::DOUBLE ELSE -embedding[i]::DOUBLE END)), 4) AS score,
         CAST(NULL AS VARCHAR) AS error_code FROM embeddings WHERE vec_id <> 13
       UNION ALL SELECT vec_id, NULL, 'ValueError' FROM embeddings WHERE vec_id = 13""",
)
def _(d):
    rows = d.table("embeddings").select("vec_id", "embedding")
    out = scoring.score(rows, _linear, "vec_id bigint, score double", batch=1, key="vec_id")
    return out.select("vec_id", r4("score").alias("score"), "error_code")


@query(
    "m07_ensemble",
    """SELECT protein_id, term, round(sum(score * CASE model WHEN 'esm_mlp' THEN 0.5 WHEN 'protcnn' THEN 0.3 ELSE 0.2 END), 6) AS score
       FROM branch_scores GROUP BY 1, 2""",
)
def _(d):
    return scoring.ensemble(d.branch_scores, WEIGHTS).withColumn("score", r6("score"))


@query(
    "m08_with_branches",
    """SELECT model, protein_id, term, round(score, 6) AS score FROM branch_scores
       UNION ALL SELECT 'ensemble', protein_id, term, round(sum(score * CASE model WHEN 'esm_mlp' THEN 0.5 WHEN 'protcnn' THEN 0.3 ELSE 0.2 END), 6)
       FROM branch_scores GROUP BY 2, 3""",
)
def _(d):
    rows = scoring.with_branches(scoring.ensemble(d.branch_scores, WEIGHTS), d.branch_scores)
    return rows.select("model", "protein_id", "term", r6("score").alias("score"))


# --- metrics -----------------------------------------------------------------------------------



def _metric_sql(grid, group="", source="pairs", aspects=False) -> str:
    extra = ", aspect" if aspects else ""
    join = "JOIN (SELECT term, aspect FROM ontology) USING (term)" if aspects else ""
    nt = "(SELECT count(*) FROM ontology o WHERE o.aspect = c.aspect)" if aspects else "(SELECT count(*) FROM scored_terms)"
    return f"""per AS (SELECT t AS threshold{extra}, term, sum(CASE WHEN label = 1 AND score >= t THEN 1 ELSE 0 END) AS tp,
          sum(CASE WHEN label = 0 AND score >= t THEN 1 ELSE 0 END) AS fp,
          sum(CASE WHEN label = 1 AND NOT coalesce(score >= t, FALSE) THEN 1 ELSE 0 END) AS fn
        FROM {source} {join} CROSS JOIN (SELECT unnest({grid}::DOUBLE[]) AS t) GROUP BY ALL),
      met AS (SELECT threshold{extra}, coalesce(2.0 * sum(tp) / nullif(2.0 * sum(tp) + sum(fp) + sum(fn), 0), 0) AS micro_f1,
          coalesce(sum(tp) / nullif(sum(tp) + sum(fp), 0), 0) AS micro_precision, coalesce(sum(tp) / nullif(sum(tp) + sum(fn), 0), 0) AS micro_recall,
          sum(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0)) / max({nt}) AS macro_f1,
          (sum(tp) + sum(fp)) / (SELECT count(*) FROM scored_proteins) AS avg_pred_terms FROM per c GROUP BY ALL)"""


COLUMNS = ("micro_f1", "micro_precision", "micro_recall", "macro_f1", "avg_pred_terms")
ROUNDED = ", ".join(f"round({c}, 6) AS {c}" for c in COLUMNS)


def _rounded():
    return [r6(c).alias(c) for c in COLUMNS]


@query("m09_basic_metrics", f"WITH {_metric_sql([0.5])} SELECT threshold, {ROUNDED} FROM met")
def _(d):
    counts = metrics.term_counts(metrics.pair_table(d.truth, d.scores), [0.5])
    n, t = metrics.count_of(d.scored_proteins, "protein_id"), metrics.count_of(d.scored_terms, "term")
    return metrics.basic_metrics(counts, n, t).select("threshold", *_rounded())


@query(
    "m10_pr_at_k",
    """WITH b AS (SELECT * FROM pairs WHERE score IS NOT NULL QUALIFY row_number() OVER (PARTITION BY protein_id ORDER BY score DESC, term) <= 3),
       h AS (SELECT protein_id, sum(label) AS hits FROM b GROUP BY 1), t AS (SELECT protein_id, sum(label) AS n FROM pairs GROUP BY 1)
       SELECT CAST(3 AS BIGINT) AS k, round(sum(hits) / 3.0 / (SELECT count(*) FROM scored_proteins), 6) AS precision_at_k,
              round(sum(hits / greatest(n, 1)) / (SELECT count(*) FROM scored_proteins), 6) AS recall_at_k FROM h JOIN t USING (protein_id)""",
)
def _(d):
    rows = metrics.pr_at_k(metrics.pair_table(d.truth, d.scores), 3, d.scored_proteins, d.scored_terms)
    return rows.select(big("k").alias("k"), r6("precision_at_k").alias("precision_at_k"), r6("recall_at_k").alias("recall_at_k"))


@query(
    "m11_tune",
    f"""WITH {_metric_sql(GRID)} SELECT threshold, {ROUNDED}, threshold = (SELECT arg_min(threshold, (-micro_f1, threshold)) FROM met) AS is_best FROM met""",
)
def _(d):
    rows = metrics.tune(metrics.pair_table(d.truth, d.scores), GRID, d.scored_proteins, d.scored_terms)
    return rows.select("threshold", *_rounded(), "is_best")


WEIGHTED = """wm AS (SELECT threshold, tp / greatest(tp + fp, 1e-12) AS p, tp / greatest(tp + fn, 1e-12) AS r FROM
    (SELECT threshold, sum(tp * coalesce(ia, 1.0)) AS tp, sum(fp * coalesce(ia, 1.0)) AS fp, sum(fn * coalesce(ia, 1.0)) AS fn
     FROM per LEFT JOIN ia USING (term) GROUP BY 1))"""


@query(
    "m12_weighted_micro",
    f"""WITH {_metric_sql(GRID)}, {WEIGHTED} SELECT threshold, round(p, 6) AS weighted_micro_precision, round(r, 6) AS weighted_micro_recall,
        round(2 * p * r / greatest(p + r, 1e-12), 6) AS weighted_micro_f1 FROM wm""",
)
def _(d):
    counts = metrics.term_counts(metrics.pair_table(d.truth, d.scores), GRID)
    rows = metrics.weighted_micro(counts, d.ia.withColumnRenamed("ia", "weight"))
    return rows.select("threshold", *[r6(c).alias(c) for c in rows.columns if c != "threshold"])


@query(
    "m13_aspect_metrics",
    f"""WITH {_metric_sql([0.5], aspects=True)} SELECT aspect, threshold, (SELECT count(*) FROM ontology o WHERE o.aspect = met.aspect) AS num_terms, {ROUNDED} FROM met""",
)
def _(d):
    rows = metrics.aspect_metrics(metrics.pair_table(d.truth, d.scores), 0.5, d.scored_proteins, d.ontology)
    return rows.select("aspect", "threshold", "num_terms", *_rounded())


@query(
    "m14_metric_grid",
    f"""WITH RECURSIVE {PATHS},
      g_truth AS (SELECT DISTINCT protein_id, target AS term FROM truth JOIN paths USING (term)),
      v AS (SELECT 'raw' AS label_set, t.protein_id, t.term FROM truth t UNION ALL SELECT 'graph', protein_id, term FROM g_truth),
      sc AS (SELECT 'raw' AS score_set, protein_id, term, score FROM scores UNION ALL SELECT 'propagated', protein_id, term, score FROM lifted),
      variants AS (SELECT * FROM (VALUES ('raw_raw', 'raw', 'raw'), ('graph_raw', 'graph', 'raw'), ('graph_propagated', 'graph', 'propagated')) x(name, l, s)),
      t1 AS (SELECT name, protein_id, term FROM variants JOIN v ON label_set = l), s1 AS (SELECT name, protein_id, term, score FROM variants JOIN sc ON score_set = s),
      all_pairs AS (SELECT coalesce(t1.name, s1.name) AS name, coalesce(t1.protein_id, s1.protein_id) AS protein_id, coalesce(t1.term, s1.term) AS term, score,
                    CASE WHEN t1.term IS NULL THEN 0 ELSE 1 END AS y
                    FROM t1 FULL OUTER JOIN s1 ON t1.name = s1.name AND t1.protein_id = s1.protein_id AND t1.term = s1.term),
      c AS (SELECT name, t AS threshold, term, sum(CASE WHEN y = 1 AND score >= t THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND score >= t THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN y = 1 AND NOT coalesce(score >= t, FALSE) THEN 1 ELSE 0 END) AS fn
            FROM all_pairs CROSS JOIN (SELECT unnest([0.3, 0.6]::DOUBLE[]) AS t) GROUP BY 1, 2, 3),
      m AS (SELECT name, threshold, 2.0 * sum(tp) / (2.0 * sum(tp) + sum(fp) + sum(fn)) AS micro_f1,
              sum(coalesce(2.0 * tp / nullif(2.0 * tp + fp + fn, 0), 0)) / (SELECT count(*) FROM scored_terms) AS macro_f1,
              sum(tp * coalesce(ia, 1.0)) AS wtp, sum(fp * coalesce(ia, 1.0)) AS wfp, sum(fn * coalesce(ia, 1.0)) AS wfn
            FROM c LEFT JOIN ia USING (term) GROUP BY 1, 2)
      SELECT name AS label, threshold, round(micro_f1, 6) AS micro_f1, round(macro_f1, 6) AS macro_f1, round(2 * wtp / (2 * wtp + wfp + wfn), 6) AS weighted_micro_f1 FROM m""",
)
def _(d):
    terms = prep.select_terms(d.annotations)
    edges = joins.selected_edges(d.edges, terms)
    paths = graph.score_paths(d.edges, terms)
    lifted_truth = d.truth.join(paths, "term").select("protein_id", F.col("target").alias("term")).distinct()
    rows = metrics.metric_grid(
        {"raw": d.truth, "graph": lifted_truth},
        {"raw": d.scores, "propagated": graph.propagate_scores(d.scores, paths)},
        [("raw_raw", "raw", "raw"), ("graph_raw", "graph", "raw"), ("graph_propagated", "graph", "propagated")],
        [0.3, 0.6], d.scored_proteins, d.scored_terms, d.ia.withColumnRenamed("ia", "weight"), edges,
    )
    return rows.select("label", "threshold", *[r6(c).alias(c) for c in ("micro_f1", "macro_f1", "weighted_micro_f1")])


@query(
    "m15_normalize_predictions",
    """SELECT protein_id, term, round(least(score * 1.5 - 0.25, 1.0), 6) AS score FROM scores WHERE score * 1.5 - 0.25 > 0 AND term % 11 <> 0""",
)
def _(d):
    raw = d.scores.withColumn("score", F.when(F.col("term") % 11 != 0, F.col("score") * 1.5 - 0.25))
    return scoring.normalize_predictions(raw).select("protein_id", "term", r6("score").alias("score"))


@query(
    "m16_ground_truth",
    """SELECT DISTINCT a.protein_id, a.term FROM annotations a JOIN splits s ON s.protein_id = a.protein_id AND s.split = 'test'
       WHERE a.term IN (SELECT term FROM selected)""",
)
def _(d):
    ids = prep.split(prep.strata(d.annotations)).filter("split = 'test'")
    return prep.ground_truth(d.annotations, ids, prep.select_terms(d.annotations))


EVAL = """w AS (SELECT o.term, o.aspect AS namespace, coalesce(ia.ia, 1.0) AS ia FROM ontology o LEFT JOIN ia ON ia.term = o.term),
    full_paths AS (SELECT term, ancestor AS target FROM closure UNION ALL SELECT term, term FROM ontology),
    lab AS (SELECT DISTINCT protein_id, target AS term FROM truth JOIN full_paths USING (term)),
    prd AS (SELECT protein_id, target AS term, max(score) AS score FROM scores JOIN full_paths USING (term) GROUP BY 1, 2),
    cell AS (SELECT w.namespace, coalesce(l.protein_id, p.protein_id) AS protein_id, coalesce(p.score, 0) AS score, (l.term IS NOT NULL)::INT AS y, w.ia
             FROM lab l FULL OUTER JOIN prd p ON l.protein_id = p.protein_id AND l.term = p.term JOIN w ON w.term = coalesce(l.term, p.term)),
    tot AS (SELECT namespace, protein_id, sum(y) AS nt, sum(y * ia) AS wt FROM cell GROUP BY 1, 2 HAVING sum(y) > 0),
    fold AS (SELECT namespace, protein_id, round(score * 50) AS lvl, sum(1) AS n, sum(y) AS tp, sum(ia) AS wn, sum(y * ia) AS wtp FROM cell WHERE score > 0 GROUP BY 1, 2, 3),
    at_tau AS (SELECT namespace, protein_id, k / 10.0 AS tau, sum(n) AS n, sum(tp) AS tp, sum(wn) AS wn, sum(wtp) AS wtp
               FROM fold, (SELECT unnest(range(1, 10)) AS k) WHERE lvl >= k * 5 GROUP BY 1, 2, 3),
    g AS (SELECT namespace, count(*) AS n_gt, sum(nt) AS nt, sum(wt) AS wt FROM tot GROUP BY 1),
    agg AS (SELECT a.namespace, tau, count(*) AS cov, sum(a.tp / a.n) AS pr, sum(a.tp / t.nt) AS rc, sum(a.wtp / a.wn) AS wpr, sum(a.wtp / t.wt) AS wrc,
              sum(a.tp) AS tp, sum(a.n) AS n, sum(a.wtp) AS wtp, sum(a.wn) AS wn FROM at_tau a JOIN tot t USING (namespace, protein_id) GROUP BY 1, 2),
    rat AS (SELECT namespace, tau, cov / n_gt AS cov, pr / cov AS pr, rc / n_gt AS rc, wpr / cov AS wpr, wrc / n_gt AS wrc, tp / n AS mp, tp / g.nt AS mr,
              wtp / wn AS wmp, wtp / g.wt AS wmr, (wn - wtp) / n_gt AS mi, (g.wt - wtp) / n_gt AS ru FROM agg JOIN g USING (namespace))"""


@query(
    "m17_cafa_eval",
    f"""WITH {EVAL} SELECT namespace, round(tau, 6) AS tau, round(cov, 6) AS cov, round(pr, 6) AS pr, round(rc, 6) AS rc, round(2 * pr * rc / (pr + rc), 6) AS f,
        round(2 * wpr * wrc / (wpr + wrc), 6) AS f_w, round(2 * mp * mr / (mp + mr), 6) AS f_micro, round(2 * wmp * wmr / (wmp + wmr), 6) AS f_micro_w,
        round(sqrt(mi * mi + ru * ru), 5) AS s FROM rat""",
)
def _(d):
    rows = _evaluation(d)
    return rows.select("namespace", "tau", *[r6(c).alias(c) for c in ("cov", "pr", "rc", "f", "f_w", "f_micro", "f_micro_w")], F.round("s", 5).alias("s"))


@query(
    "m17_final_score",
    f"""WITH {EVAL} SELECT round(avg(best), 6) AS final_score FROM (SELECT namespace, max(2 * wpr * wrc / (wpr + wrc)) AS best FROM rat GROUP BY 1)""",
)
def _(d):
    return evaluate.final_score(_evaluation(d)).select(r6("final_score").alias("final_score"))


def _evaluation(d):
    terms = joins.with_ia(d.ontology.select("term", F.col("aspect").alias("namespace")), d.ia.hint("merge"))
    return evaluate.cafa_eval(d.scores, d.truth, d.edges, terms, options=evaluate.EvalOptions(step=0.1))


def option_sql(norm="cafa", best="max(score)", most=None, wanted="TRUE", known="FALSE"):
    """The evaluation at steps of 0.01 under one option. ``wanted`` filters terms, ``known`` true answers."""
    kept = "" if most is None else f"QUALIFY row_number() OVER (PARTITION BY protein_id, aspect ORDER BY score DESC, term) <= {most}"
    by_pr, by_rc = {"cafa": ("c", "n_gt"), "pred": ("c", "c"), "gt": ("n_gt", "n_gt")}[norm]
    ratio = lambda a, b: f"coalesce({a} / nullif({b}, 0), 0)"
    f = lambda a, b: f"round(coalesce(2 * {a} * {b} / nullif({a} + {b}, 0), 0), 6)"
    return f"""WITH w AS (SELECT o.term, o.aspect AS namespace, coalesce(ia.ia, 1.0) AS ia FROM ontology o LEFT JOIN ia ON ia.term = o.term WHERE {wanted}),
    full_paths AS (SELECT term, ancestor AS target FROM closure UNION ALL SELECT term, term FROM ontology),
    asked AS (SELECT s.* FROM scores s JOIN ontology USING (term) WHERE score > 0 AND protein_id IN (SELECT protein_id FROM truth) {kept}),
    lab AS (SELECT DISTINCT protein_id, target AS term FROM truth JOIN full_paths USING (term)),
    prd AS (SELECT protein_id, target, {best} AS score FROM asked JOIN full_paths USING (term) GROUP BY 1, 2),
    cell AS (SELECT w.namespace, coalesce(l.protein_id, p.protein_id) AS protein_id, coalesce(p.score, 0) AS score, (l.term IS NOT NULL)::INT AS y, w.ia
             FROM lab l FULL OUTER JOIN prd p ON l.protein_id = p.protein_id AND l.term = p.target JOIN w ON w.term = coalesce(l.term, p.target)
             WHERE (coalesce(l.protein_id, p.protein_id), w.term) NOT IN (SELECT (t.protein_id, t.term) FROM truth t WHERE {known})),
    tot AS (SELECT namespace, protein_id, sum(y) AS nt, sum(y * ia) AS wt FROM cell GROUP BY 1, 2 HAVING sum(y) > 0),
    fold AS (SELECT namespace, protein_id, round(score * 50) AS lvl, sum(1) AS n, sum(y) AS tp, sum(ia) AS wn, sum(y * ia) AS wtp FROM cell WHERE score > 0 GROUP BY 1, 2, 3),
    k AS (SELECT unnest(range(1, 100)) AS k),
    at_tau AS (SELECT namespace, protein_id, k, sum(n) AS n, sum(tp) AS tp, sum(wn) AS wn, sum(wtp) AS wtp FROM fold, k WHERE lvl * 2 >= k GROUP BY 1, 2, 3),
    g AS (SELECT namespace, count(*) AS n_gt, sum(wt) AS wt FROM tot GROUP BY 1),
    agg AS (SELECT a.namespace, k, count(*) AS c, sum(a.tp / a.n) AS pr, sum(a.tp / t.nt) AS rc, sum({ratio("a.wtp", "a.wn")}) AS wpr, sum({ratio("a.wtp", "t.wt")}) AS wrc,
              sum(a.wn - a.wtp) AS mi, sum(a.wtp) AS wtp FROM at_tau a JOIN tot t USING (namespace, protein_id) GROUP BY 1, 2),
    r AS (SELECT namespace, k, coalesce(c, 0) / n_gt AS cov, {ratio("pr", by_pr)} AS pr, {ratio("rc", by_rc)} AS rc, {ratio("wpr", by_pr)} AS wpr, {ratio("wrc", by_rc)} AS wrc,
            coalesce(mi, 0) / n_gt AS mi, (g.wt - coalesce(wtp, 0)) / n_gt AS ru FROM g CROSS JOIN k LEFT JOIN agg USING (namespace, k))
    SELECT namespace, round(k / 100.0, 6) AS tau, round(cov, 6) AS cov, round(pr, 6) AS pr, round(rc, 6) AS rc, {f("pr", "rc")} AS f, {f("wpr", "wrc")} AS f_w,
      round(sqrt(mi * mi + ru * ru), 5) AS s FROM r"""


def under_option(d, toi=None, known=None, **options):
    terms = joins.with_ia(d.ontology.select("term", F.col("aspect").alias("namespace")), d.ia.hint("merge"))
    rows = evaluate.cafa_eval(d.scores, d.truth, d.edges, terms, toi, known, evaluate.EvalOptions(**options))
    return rows.select("namespace", "tau", *[r6(c).alias(c) for c in ("cov", "pr", "rc", "f", "f_w")], F.round("s", 5).alias("s"))


@query("m17_norm_pred", option_sql(norm="pred"))
def _(d):
    return under_option(d, norm="pred")


@query("m17_norm_gt", option_sql(norm="gt"))
def _(d):
    return under_option(d, norm="gt")


@query("m17_fill", option_sql(best="coalesce(max(CASE WHEN term = target THEN score END), max(score))"))
def _(d):
    return under_option(d, fill=True)


@query("m17_max_terms", option_sql(most=3))
def _(d):
    return under_option(d, max_terms=3)


@query("m17_no_orphans", option_sql(wanted="o.term IN (SELECT child FROM edges)"))
def _(d):
    return under_option(d, no_orphans=True)


@query("m17_terms_of_interest", option_sql(wanted="o.term % 5 <> 0"))
def _(d):
    return under_option(d, toi=d.ontology.filter("term % 5 <> 0"))


@query("m17_known_annotations", option_sql(known="t.term % 4 = 0"))
def _(d):
    return under_option(d, known=d.truth.filter("term % 4 = 0"))
