"""Duplicate removal: greedy two-key matching, latest rows, timeline merges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import join_same, keep_first


def _without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose keys, nulls included, are not in ``other``."""
    side = other.select(*[F.col(k).alias(f"_other{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_other{k}")) for k in keys])
    return df.join(side, same, "left_anti")


def _first_two(df: DataFrame, keys: Sequence[str], names: tuple[str, str]) -> DataFrame:
    """The two smallest ``_o`` per key; every task sends two rows per key at most."""
    two = keep_first(df.select(*keys, "_o"), keys, [F.col("_o")], 2)
    second = F.when(F.count("*") > 1, F.max("_o"))
    return two.groupBy(*keys).agg(F.min("_o").alias(names[0]), second.alias(names[1]))


def _run_ends(runs: DataFrame) -> DataFrame:
    """(_o, _end, _odd): where each run of edges that hang on one earlier edge starts, and whether an odd
    number of steps leads there. ``runs`` has (_o, _before). Each round doubles the reach of all pointers.
    """
    reach = cut_lineage(runs.select("_o", F.col("_before").alias("_end"), F.lit(True).alias("_odd")))
    while True:
        onward = reach.select(F.col("_o").alias("_end"), F.col("_end").alias("_next"), F.col("_odd").alias("_next_odd"))
        moved = cut_lineage(
            reach.join(onward, "_end", "left").select(
                "_o",
                F.coalesce("_next", "_end").alias("_end"),
                (F.col("_odd") != F.coalesce("_next_odd", F.lit(False))).alias("_odd"),
                F.col("_next").isNotNull().alias("_moved"),
            )
        )
        if moved.filter("_moved").isEmpty():
            return reach
        reach = moved.drop("_moved")


def _plain_round(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges that come first at both ends, the others)."""
    at_request = active.groupBy("_r").agg(F.min("_o").alias("_r1"))
    at_content = active.groupBy("_p", "_c").agg(F.min("_o").alias("_c1"))
    ranked = join_same(join_same(active, at_request, ["_r"]), at_content, ["_p", "_c"])
    sure = (F.col("_o") == F.col("_r1")) & (F.col("_o") == F.col("_c1"))
    ranked = cut_lineage(ranked.select("_r", "_p", "_c", "_o", sure.alias("_sure")))
    return ranked.filter("_sure").drop("_sure"), ranked.filter("NOT _sure").drop("_sure")


def _run_round(active: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges that are first at both ends or an even number of steps along a run that starts at one,
    the others)."""
    at_request = _first_two(active, ["_r"], ("_r1", "_r2"))
    at_content = _first_two(active, ["_p", "_c"], ("_c1", "_c2"))
    joined = join_same(join_same(active, at_request, ["_r"]), at_content, ["_p", "_c"])
    o = F.col("_o")
    before = F.when((o == F.col("_c1")) & (o == F.col("_r2")), F.col("_r1")).when((o == F.col("_r1")) & (o == F.col("_c2")), F.col("_c1"))
    sure = (o == F.col("_r1")) & (o == F.col("_c1"))
    ranked = cut_lineage(joined.select("_r", "_p", "_c", "_o", sure.alias("_sure"), before.alias("_before")))
    first = ranked.filter("_sure").select(F.col("_o").alias("_end"))
    along = _run_ends(ranked.filter("_before IS NOT NULL")).filter("NOT _odd").join(first, "_end", "left_semi")
    rest = ranked.filter("NOT _sure").select("_r", "_p", "_c", "_o")
    settled = ranked.filter("_sure").select("_r", "_p", "_c", "_o").unionByName(rest.join(along.select("_o"), "_o", "left_semi"))
    return cut_lineage(settled), rest


def kept_positions(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Positions ``_o`` of the events a first-come pass over ``order`` would keep.

    Every event is an edge between its request id and its (protein, checksum) content; the pass
    keeps an edge when both ends are still free. An edge that comes first at both of its ends is
    certainly kept, and everything touching it is certainly dropped; a round settles all such edges at
    once. Where a round leaves more than half of them open, the next one follows runs: an edge that has
    one earlier neighbour in all is kept exactly if that one is not, so along a run that starts at a kept
    edge every other edge is kept. Starts of runs are found by pointer doubling, so a chain of m events
    takes log2(m) rounds.

    Copies of one edge are folded before any join; the first edges of an end are partially aggregated
    minima, or windows that Spark prunes on every task, and the joins against them have one row per
    end, so a hot id is split by adaptive execution instead of landing in one task. Null ids and contents
    are keys like others. Rounds go on until no edge is undecided.
    """
    edges = df.select(
        F.col("request_id").alias("_r"),
        F.col("protein_id").alias("_p"),
        F.col("checksum").alias("_c"),
        F.struct(*order).alias("_o") if len(order) > 1 else F.col(order[0]).alias("_o"),
    )
    active = edges.groupBy("_r", "_p", "_c").agg(F.min("_o").alias("_o"))
    kept: list[DataFrame] = []
    rule, open_before = _plain_round, None
    while True:
        settled, rest = rule(active)
        kept.append(settled.select("_o"))
        active = cut_lineage(_without(_without(rest, settled, ["_r"]), settled, ["_p", "_c"]))
        left = active.count()
        if left == 0:
            return reduce(DataFrame.unionByName, kept)
        rule = _run_round if open_before is not None and 2 * left > open_before else _plain_round
        open_before = left


def flag_duplicates(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """All events plus ``kept``: whether the first-come pass keeps them."""
    kept = kept_positions(df, order).withColumn("_kept", F.lit(True))
    place = F.struct(*order) if len(order) > 1 else F.col(order[0])
    joined = df.withColumn("_o", place).join(kept, "_o", "left")
    return joined.select(*df.columns, F.coalesce("_kept", F.lit(False)).alias("kept"))


def dedupe_events(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """D-01: drop an event whose request id, or whose (protein, checksum), was already kept."""
    return flag_duplicates(df, order).filter("kept").drop("kept")


def skipped_status(duplicates: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """D-02: status rows for dropped events; columns ``keep`` go along."""
    return duplicates.select(
        "request_id",
        "protein_id",
        F.lit("SKIPPED").alias("current_status"),
        F.lit("spark_dedup").alias("stage_name"),
        F.lit("DUPLICATE_EVENT").alias("error_code"),
        F.lit("Duplicate request_id or protein checksum in micro-batch.").alias("error_message"),
        *keep,
    )


def mark_duplicates(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """D-02: the dropped events, labelled."""
    return skipped_status(flag_duplicates(df, order).filter(~F.col("kept")))


def distinct_pairs(df: DataFrame, columns: Sequence[str] = ("protein_id", "term")) -> DataFrame:
    """D-03."""
    return df.select(*columns).dropDuplicates()


def merge_events(stored: DataFrame, live: DataFrame, n: int = 300, seq: str = "seq") -> DataFrame:
    """D-04: union of two timelines; per (type, time, modal event, modal step) the last row wins;
    the latest ``n`` per request stay. ``live`` rows come after ``stored`` rows.
    """
    both = stored.withColumn("_side", F.lit(0)).unionByName(
        live.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    event = F.coalesce("modal_event", F.lit(""))
    step = F.coalesce("modal_step", F.lit(""))
    keys = [F.col("request_id"), F.col("event_type"), F.col("event_ts"), event, step]
    unique = keep_first(both, keys, [F.desc("_side"), F.desc(seq)])
    newest = [F.desc("event_ts"), F.desc("_side"), F.desc(seq)]
    return keep_first(unique, ["request_id"], newest, n).drop("_side")


def latest_requests(df: DataFrame, ts: str = "updated_at", seq: str = "seq") -> DataFrame:
    """D-05: latest row per request; the later row wins a tie."""
    return keep_first(df, ["request_id"], [F.desc(ts), F.desc(seq)])


def last_by_id(df: DataFrame, key: str = "protein_id", position: str = "position") -> DataFrame:
    """D-06: the last record of a repeated id."""
    return keep_first(df, [key], [F.desc(position)])


def first_by_protein(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """D-07: first prediction per protein of a request, ignoring case."""
    return keep_first(df, [F.col("request_id"), F.lower("protein_id")], order)


def latest_prediction_by_request_protein(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """D-08: last write per (request, protein), ignoring case; ``order`` is newest first."""
    return keep_first(df, [F.col("request_id"), F.lower("protein_id")], order)
