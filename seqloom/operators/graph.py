"""Ontology graph: closure, label and score propagation, degrees, violations."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators import lists as L
from seqloom.operators.joins import selected_edges
from seqloom.operators.lineage import cut_lineage, cuts_dropped, drop_cuts

# Enough doublings for any path in a graph of 2**40 terms; more means a cycle.
MAX_DOUBLINGS = 40


def _climbed(exact: DataFrame, onward: DataFrame, reach: DataFrame) -> DataFrame:
    """One row per term: what it reached so far and what its ``exact`` ancestors reach, without repeats."""
    far = exact.join(onward, "_mid").select(F.col("_from").alias("term"), "near", "exact")
    none = F.array().cast(reach.schema["exact"].dataType)
    own = reach.select("term", F.concat("near", "exact").alias("near"), none.alias("exact"))
    # dealt by term first, so that lists are joined where they arrive and not written twice
    met = own.unionByName(far).repartition("term").groupBy("term")
    lists = met.agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("near", "exact")])
    return lists.select("term", F.array_except("near", "exact").alias("near"), F.array_distinct("exact").alias("exact"))


def ancestors(edges: DataFrame) -> DataFrame:
    """G-01: all (term, ancestor) pairs of an acyclic child-to-parent edge table.

    Round k holds each term's ancestors at distance 1..2^k as two lists: those that one of the paths reaches
    in exactly 2^k steps, and the others. Joining the exact ones with all lists doubles the reach, and the list
    an ancestor comes from tells whether the result is exact again, so one join and one aggregation per
    round suffice and a graph of depth d takes log2(d) rounds. Lists travel instead of pairs, so a term is
    written once for all its ancestors; repeats are dropped inside the lists.
    """
    start = edges.select(F.col("child").alias("term"), F.col("parent").alias("ancestor")).distinct()
    # a list of lists keeps null parents
    first = start.groupBy("term").agg(F.flatten(F.collect_list(F.array("ancestor"))).alias("exact"))
    none = F.array().cast(first.schema["exact"].dataType)
    reach = cut_lineage(first.select("term", none.alias("near"), "exact"))
    for _ in range(MAX_DOUBLINGS):
        if reach.filter(F.size("exact") > 0).isEmpty():
            return reach.select("term", F.explode("near").alias("ancestor"))
        exact = reach.select(F.col("term").alias("_from"), F.explode("exact").alias("_mid"))
        reach = cut_lineage(_climbed(exact, reach.withColumnRenamed("term", "_mid"), reach))
    raise ValueError("the edge table contains a cycle")


def _merge(batches):
    """One row per node from all its rows: sorted codes, those reached in exactly so many steps negative and listed once more."""
    for table, group in L.whole_groups(batches, "node"):
        nodes, mine, lens = L.column(table, "node"), L.column(table, "mine").astype(bool), L.lengths(table, "codes")
        codes, weights, before = L.entries(table, "codes"), L.entries(table, "weights"), np.r_[0, np.cumsum(lens)]
        for lo, hi in L.blocks(group, lens):
            here = slice(before[lo], before[hi])
            signed, at = codes[here].astype(np.int64), group[lo:hi] - group[lo]
            row, order, heads, owner = L.meet(at, lens[lo:hi], np.abs(signed))
            # what a node reached before in exactly so many steps is nearer now
            exact = np.logical_or.reduceat(((signed < 0) & ~mine[lo:hi][row])[order], heads)
            found, n = np.abs(signed[order[heads]]).astype(np.int32), int(at[-1]) + 1
            first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes[lo:hi][first].astype(np.int32)),
                    L.list_array(np.where(exact, -found, found), np.bincount(owner, minlength=n)),
                    L.list_array(weights[here][order[heads]], np.bincount(owner, minlength=n)),
                    L.list_array(found[exact], np.bincount(owner[exact], minlength=n)),
                ],
                names=["node", "codes", "weights", "exact"],
            )


def ancestor_lists(edges: DataFrame, most: int, per_node: int) -> DataFrame:
    """G-01 for numbered nodes as lists: (node, codes, weights), the ancestors of every child in order of their numbers.

    ``edges`` has child, parent (from 1 on) and the weight of the parent, which travels with it. The rounds are those of
    :func:`ancestors`; lists are merged by one sort per batch, and a round goes over the nodes in pieces, so that
    about ``most`` entries, or ``per_node`` for every node, are on their way at a time.
    """
    schema = "node int, codes array<int>, weights array<double>, exact array<int>"
    merged = lambda df: df.repartition("node").sortWithinPartitions("node").mapInArrow(_merge, schema)
    signed = F.array((-F.col("parent")).cast("int")).alias("codes")
    start = edges.select(F.col("child").cast("int").alias("node"), F.lit(False).alias("mine"), signed, F.array(F.col("weight").cast("double")).alias("weights"))
    with cuts_dropped(edges.sparkSession) as made:
        parts = [cut_lineage(merged(start))]
        for _ in range(MAX_DOUBLINGS):
            reach = reduce(DataFrame.unionByName, parts)
            drop_cuts(edges.sparkSession, made, but=len(parts))
            n_nodes, n_codes, n_exact = reach.agg(F.count("*"), F.sum(F.size("codes")), F.sum(F.size("exact"))).first()
            if not n_exact:
                made.clear()
                return reach.select("node", "codes", "weights")
            pieces = max(1, n_exact * n_codes // n_nodes // max(most, per_node * n_nodes))
            mine = reach.select("node", F.lit(True).alias("mine"), "codes", "weights")
            exact = reach.select(F.col("node").alias("_from"), F.explode("exact").alias("_mid"))
            onward = reach.select(F.col("node").alias("_mid"), F.lit(False).alias("mine"), "codes", "weights")
            far = exact.join(onward, "_mid").select(F.col("_from").alias("node"), "mine", "codes", "weights")
            piece = F.pmod(F.xxhash64("node"), F.lit(pieces))
            parts = [cut_lineage(merged(mine.unionByName(far).filter(piece == k))) for k in range(pieces)]
    raise ValueError("the edge table contains a cycle")


def propagate_labels(ann: DataFrame, closure: DataFrame, selected: DataFrame | None) -> DataFrame:
    """G-02: terms and all their ancestors per protein, then the selected ones only.

    Paths may pass through unselected terms. The closure is cut to selected ancestors before it
    meets the annotations, so no row is made that the filter would drop.
    """
    labels = ann.select("protein_id", "term").distinct()
    direct, reach = labels, closure
    if selected is not None:
        chosen = selected.select("term")
        direct = labels.join(chosen, "term", "left_semi").select("protein_id", "term")
        reach = closure.join(chosen.withColumnRenamed("term", "ancestor"), "ancestor", "left_semi")
    lifted = labels.join(reach, "term").select("protein_id", F.col("ancestor").alias("term"))
    return direct.unionByName(lifted).distinct()


def score_paths(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """Pairs (term, target) a score travels along: selected edges only, plus every term to itself."""
    inner = ancestors(selected_edges(edges, terms)).withColumnRenamed("ancestor", "target")
    own = terms.select("term", F.col("term").alias("target"))
    return inner.unionByName(own)


def propagate_scores(scores: DataFrame, paths: DataFrame, keys: tuple[str, ...] = ("protein_id",)) -> DataFrame:
    """G-03: every term gets the best score among itself and its descendants.

    One aggregation with map-side combine instead of repeated passes; always the fixed point.
    """
    spread = scores.join(paths, "term").select(*keys, F.col("target").alias("term"), "score")
    return spread.groupBy(*keys, "term").agg(F.max("score").alias("score"))


def fill_scores(scores: DataFrame, paths: DataFrame, keys: tuple[str, ...] = ("protein_id",)) -> DataFrame:
    """Variant of G-03 where a term that has its own score keeps it."""
    spread = scores.join(paths, "term").select(
        *keys,
        F.col("target").alias("term"),
        "score",
        F.when(F.col("term") == F.col("target"), F.col("score")).alias("_own"),
    )
    best = spread.groupBy(*keys, "term").agg(F.max("score").alias("_best"), F.max("_own").alias("_own"))
    return best.select(*keys, "term", F.coalesce("_own", "_best").alias("score"))


def degrees(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """G-04: numbers of selected parents and children per selected term."""
    inner = selected_edges(edges, terms)
    ups = inner.groupBy(F.col("child").alias("term")).agg(F.count("*").alias("n_parents"))
    downs = inner.groupBy(F.col("parent").alias("term")).agg(F.count("*").alias("n_children"))
    return (
        terms.select("term")
        .join(ups, "term", "left")
        .join(downs, "term", "left")
        .select(
            "term",
            F.coalesce("n_parents", F.lit(0)).alias("n_parents"),
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
        )
    )


def hierarchy_violations(scores: DataFrame, edges: DataFrame, proteins: DataFrame) -> DataFrame:
    """G-05: share of (protein, edge) where the child exceeds its parent, and the mean excess.

    Only scored children can exceed, so nothing dense is built; the divisor counts all cells. The
    scores are read twice, so they are written first: they are often the result of a propagation.
    """
    scores = cut_lineage(scores.select("protein_id", "term", "score"))
    child = scores.select("protein_id", F.col("term").alias("child"), F.col("score").alias("_child"))
    parent = scores.select("protein_id", F.col("term").alias("parent"), F.col("score").alias("_parent"))
    gap = F.col("_child") - F.coalesce("_parent", F.lit(0.0))
    found = (
        child.join(edges.select("child", "parent").distinct(), "child")
        .join(parent, ["protein_id", "parent"], "left")
        .agg(
            F.coalesce(F.sum((gap > 1e-8).cast("bigint")), F.lit(0)).alias("violations"),
            F.coalesce(F.sum(F.greatest(gap, F.lit(0.0))), F.lit(0.0)).alias("_excess"),
        )
    )
    n_proteins = proteins.select("protein_id").distinct().agg(F.count("*")).scalar()
    n_edges = edges.select("child", "parent").distinct().agg(F.count("*")).scalar()
    cells = (n_proteins * n_edges).cast("double")
    return found.select(
        "violations",
        F.coalesce(F.try_divide(F.col("violations").cast("double"), cells), F.lit(0.0)).alias(
            "hierarchy_violation_rate"
        ),
        F.coalesce(F.try_divide(F.col("_excess"), cells), F.lit(0.0)).alias("hierarchy_violation_mean"),
    )


def label_stats(settings: dict[str, DataFrame], proteins: DataFrame) -> DataFrame:
    """G-06: total labels and mean per protein for each label setting, over all ``proteins``."""
    n = proteins.select("protein_id").distinct().agg(F.count("*")).scalar()
    out = None
    for name, labels in settings.items():
        kept = labels.join(proteins.select("protein_id"), "protein_id", "left_semi")
        row = kept.agg(F.count("*").alias("positive_labels")).select(
            F.lit(name).alias("setting"),
            "positive_labels",
            F.try_divide(F.col("positive_labels").cast("double"), n.cast("double")).alias("avg_labels_per_protein"),
        )
        out = row if out is None else out.unionByName(row)
    return out
