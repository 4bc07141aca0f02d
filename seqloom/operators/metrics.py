"""Multi-label metrics on sparse (protein, term) pairs.

A pair table holds every cell that has a label or a score; all other cells are (0, 0) and only
enter through the counts of proteins and terms.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.graph import hierarchy_violations
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import keep_first


def pair_table(truth: DataFrame, scores: DataFrame) -> DataFrame:
    """(protein_id, term, score, label): full outer join by one aggregation, best score per pair."""
    both = truth.select("protein_id", "term", F.lit(None).cast("double").alias("score"), F.lit(1).alias("label"))
    both = both.unionByName(scores.select("protein_id", "term", "score", F.lit(0).alias("label")))
    return both.groupBy("protein_id", "term").agg(F.max("score").alias("score"), F.max("label").alias("label"))


def _level(score: Column, grid: Sequence[float]) -> Column:
    """How many thresholds of the ascending ``grid`` a score reaches."""
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(float(t)) for t in grid]), lambda t: t <= score)), F.lit(0))


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2.0 * tp + fp + fn), F.lit(0.0))


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def term_counts(pairs: DataFrame, grid: Sequence[float]) -> DataFrame:
    """Per (term, threshold): tp, fp, fn.

    Scores fall into grid levels first, so the shuffle carries at most one row per term and level
    from each task, however many thresholds there are. Running sums over the levels of one term
    stay within the size of the grid.
    """
    grid = sorted(grid)
    leveled = pairs.withColumn("_level", F.when(F.col("score").isNull(), 0).otherwise(_level(F.col("score"), grid)))
    folded = leveled.groupBy("term", "_level").agg(
        F.count("*").alias("_n"), F.sum("label").alias("_t")
    )
    spread = folded.groupBy("term").agg(
        F.sum("_t").alias("_truth"),
        *[
            F.sum(F.when(F.col("_level") > i, F.col(c)).otherwise(0)).alias(f"{c}{i}")
            for i in range(len(grid))
            for c in ("_n", "_t")
        ],
    )
    cells = F.array(
        *[
            F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_n{i}").alias("n"), F.col(f"_t{i}").alias("tp"))
            for i, t in enumerate(grid)
        ]
    )
    rows = spread.select("term", "_truth", F.explode(cells).alias("_c"))
    return rows.select(
        "term",
        F.col("_c.threshold").alias("threshold"),
        F.col("_c.tp").alias("tp"),
        (F.col("_c.n") - F.col("_c.tp")).alias("fp"),
        (F.col("_truth") - F.col("_c.tp")).alias("fn"),
    )


def basic_metrics(counts: DataFrame, n_proteins: Column, n_terms: Column, keys: Sequence[str] = ()) -> DataFrame:
    """M-09: micro precision, recall, F1, macro F1 over all terms, mean predicted terms."""
    tp, fp, fn = (F.sum(c) for c in ("tp", "fp", "fn"))
    totals = counts.groupBy(*keys, "threshold").agg(
        tp.alias("_tp"), fp.alias("_fp"), fn.alias("_fn"),
        F.sum(_f1(F.col("tp"), F.col("fp"), F.col("fn"))).alias("_f1s"),
    )
    return totals.select(
        *keys,
        "threshold",
        _f1(F.col("_tp"), F.col("_fp"), F.col("_fn")).alias("micro_f1"),
        _ratio(F.col("_tp"), F.col("_tp") + F.col("_fp")).alias("micro_precision"),
        _ratio(F.col("_tp"), F.col("_tp") + F.col("_fn")).alias("micro_recall"),
        _ratio(F.col("_f1s"), n_terms).alias("macro_f1"),
        _ratio(F.col("_tp") + F.col("_fp"), n_proteins).alias("avg_pred_terms"),
    )


def count_of(df: DataFrame, c: str) -> Column:
    """Number of distinct values as a scalar subquery."""
    return df.select(c).distinct().agg(F.count("*")).scalar()


def weighted_micro(counts: DataFrame, weights: DataFrame) -> DataFrame:
    """M-12: micro metrics weighted per term (1 where a term has no weight)."""
    w = F.coalesce("weight", F.lit(1.0))
    summed = (
        counts.join(weights.select("term", "weight"), "term", "left")
        .groupBy("threshold")
        .agg(*[F.sum(w * F.col(c)).alias(c) for c in ("tp", "fp", "fn")])
    )
    floor = lambda c: F.greatest(c, F.lit(1e-12))
    pr = F.col("tp") / floor(F.col("tp") + F.col("fp"))
    rc = F.col("tp") / floor(F.col("tp") + F.col("fn"))
    return summed.select("threshold", pr.alias("_p"), rc.alias("_r")).select(
        "threshold",
        F.col("_p").alias("weighted_micro_precision"),
        F.col("_r").alias("weighted_micro_recall"),
        (2 * F.col("_p") * F.col("_r") / floor(F.col("_p") + F.col("_r"))).alias("weighted_micro_f1"),
    )


def tune(pairs: DataFrame, grid: Sequence[float], proteins: DataFrame, terms: DataFrame) -> DataFrame:
    """M-11: metrics per threshold, with ``is_best`` on the first threshold of highest micro F1."""
    rows = basic_metrics(term_counts(pairs, grid), count_of(proteins, "protein_id"), count_of(terms, "term"))
    best = Window.orderBy(F.desc("micro_f1"), F.asc("threshold"))  # one row per grid value
    return rows.withColumn("is_best", F.row_number().over(best) == 1)


def aspect_metrics(pairs: DataFrame, threshold: float, proteins: DataFrame, aspects: DataFrame) -> DataFrame:
    """M-13: metrics per aspect at one threshold, with the number of terms of each aspect."""
    counts = term_counts(pairs, [threshold]).join(aspects.select("term", "aspect"), "term")
    sizes = aspects.groupBy("aspect").agg(F.count_distinct("term").alias("num_terms"))
    tagged = counts.join(sizes, "aspect")
    n = count_of(proteins, "protein_id")
    out = basic_metrics(tagged, n, F.col("num_terms"), ["aspect", "num_terms"])
    return out


def pr_at_k(pairs: DataFrame, k: int, proteins: DataFrame, terms: DataFrame) -> DataFrame:
    """M-10: precision and recall at ``k``, mean over all proteins."""
    n_proteins, n_terms = count_of(proteins, "protein_id"), count_of(terms, "term")
    scored = pairs.filter(F.col("score").isNotNull())
    best = keep_first(scored, ["protein_id"], [F.desc("score"), F.asc("term")], k)
    hits = best.groupBy("protein_id").agg(F.sum("label").alias("_hits"))
    true = pairs.groupBy("protein_id").agg(F.sum("label").alias("_true"))
    size = F.least(F.lit(k), n_terms)
    return hits.join(true, "protein_id").agg(
        F.sum("_hits").alias("_h"), F.sum(F.col("_hits") / F.greatest(F.col("_true"), F.lit(1))).alias("_r")
    ).select(
        F.lit(k).alias("k"),
        _ratio(_ratio(F.col("_h"), size), n_proteins).alias("precision_at_k"),
        _ratio(F.col("_r"), n_proteins).alias("recall_at_k"),
    )


def metric_grid(labels: dict[str, DataFrame], scores: dict[str, DataFrame], variants: Sequence[tuple[str, str, str]],
                grid: Sequence[float], proteins: DataFrame, terms: DataFrame, weights: DataFrame,
                edges: DataFrame) -> DataFrame:
    """M-14: basic, weighted and hierarchy metrics for (name, label set, score set) variants."""
    n_proteins, n_terms = count_of(proteins, "protein_id"), count_of(terms, "term")
    labels = {k: cut_lineage(v) for k, v in labels.items()}
    scores = {k: cut_lineage(v) for k, v in scores.items()}
    per_scores = {k: hierarchy_violations(scores[k], edges, proteins) for k in dict.fromkeys(v[2] for v in variants)}
    out = None
    for name, which_labels, which_scores in variants:
        counts = term_counts(pair_table(labels[which_labels], scores[which_scores]), grid)
        broken = per_scores[which_scores]
        rows = (
            basic_metrics(counts, n_proteins, n_terms)
            .join(weighted_micro(counts, weights), "threshold")
            .withColumn("label", F.lit(name))
            .withColumn("hierarchy_violation_rate", broken.select("hierarchy_violation_rate").scalar())
            .withColumn("hierarchy_violation_mean", broken.select("hierarchy_violation_mean").scalar())
        )
        out = rows if out is None else out.unionByName(rows)
    return out
