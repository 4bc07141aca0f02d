"""Joins of sequences, annotations, ontology terms, requests and predictions.

No join here carries a broadcast hint: Spark broadcasts a side when its measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import running_totals


def annotate_sequences(sequences: DataFrame, terms: DataFrame, taxonomy: DataFrame, ia: DataFrame) -> DataFrame:
    """J-01: sequences with their terms, taxon and information accretion, all left outer."""
    return (
        sequences.join(terms, "protein_id", "left").join(taxonomy, "protein_id", "left").join(ia, "term", "left")
    )


def annotated_ids(sequences: DataFrame, terms: DataFrame) -> DataFrame:
    """J-02: proteins that have both a sequence and an annotation."""
    return sequences.select("protein_id").distinct().join(terms, "protein_id", "left_semi")


def restrict(df: DataFrame, ids: DataFrame | None = None, terms: DataFrame | None = None) -> DataFrame:
    """F-04, J-03: rows whose protein and term are both listed."""
    if ids is not None:
        df = df.join(ids.select("protein_id"), "protein_id", "left_semi")
    if terms is not None:
        df = df.join(terms.select("term"), "term", "left_semi")
    return df


def covered_share(df: DataFrame, terms: DataFrame) -> DataFrame:
    """J-03: annotation rows whose term is listed, all rows, and the share."""
    marked = df.join(terms.select("term").distinct().withColumn("_in", F.lit(1)), "term", "left")
    return marked.agg(
        F.count("_in").alias("covered_rows"),
        F.count("*").alias("all_rows"),
        F.try_divide(F.count("_in").cast("double"), F.count("*").cast("double")).alias("share"),
    )


def overlapping_ids(split: DataFrame, key: str = "protein_id") -> DataFrame:
    """J-04: ids that fall in more than one split (none, for a sound split)."""
    return (
        split.groupBy(key)
        .agg(F.min("split").alias("first_split"), F.max("split").alias("last_split"))
        .filter(F.col("first_split") != F.col("last_split"))
    )


def invalid_ids(ids: DataFrame, known: DataFrame, key: str = "protein_id") -> DataFrame:
    """J-04: listed ids that are not known."""
    return ids.join(known, key, "left_anti")


def with_ia(df: DataFrame, ia: DataFrame, default: float = 1.0) -> DataFrame:
    """J-05: information accretion by term, ``default`` where the table has none."""
    return df.join(ia.select("term", "ia"), "term", "left").withColumn("ia", F.coalesce("ia", F.lit(default)))


def term_aspects(ann: DataFrame, ontology: DataFrame) -> DataFrame:
    """J-06: majority aspect of the annotations, filled from the ontology namespace.

    Aspects are counted per (term, aspect) first, so a frequent term is reduced before the shuffle.
    """
    votes = ann.groupBy("term", "aspect").count()
    majority = votes.groupBy("term").agg(
        F.min_by("aspect", F.struct(-F.col("count"), F.col("aspect"))).alias("_voted")
    )
    filled = ontology.select("term", S.map_aspect(F.col("namespace")).alias("_from_ontology"))
    return majority.join(filled, "term", "full_outer").select(
        "term", F.coalesce("_voted", "_from_ontology").alias("aspect")
    )


def attach_results(events: DataFrame, predictions: DataFrame) -> DataFrame:
    """J-07: predictions of a scored chunk back to its events, by protein, one row each.

    An event without predictions stays as one row without a term and with 0.0; two events of one
    protein both match.
    """
    side = predictions.select("protein_id", "model", "go_term", "score", "aspect", "name", "rank")
    return events.join(side, "protein_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def attach_summary(events: DataFrame, predictions: DataFrame) -> DataFrame:
    """J-07: number of terms, highest score and first term (by ``rank``) of each event's protein.

    Predictions are aggregated per protein before the join, on every task first, so no list of them
    is ever held.
    """
    per_protein = predictions.groupBy("protein_id").agg(
        F.count("*").alias("n_terms"), F.max("score").alias("max_score"), F.min_by("go_term", "rank").alias("first_term")
    )
    joined = events.join(per_protein, "protein_id", "left")
    return joined.withColumns(
        {"n_terms": F.coalesce("n_terms", F.lit(0)), "max_score": F.coalesce("max_score", F.lit(0.0))}
    )


def enrich_terms(df: DataFrame, ontology: DataFrame) -> DataFrame:
    """J-08: fill missing term name, ontology code and definition; existing values win."""
    side = ontology.select(
        F.col("term").alias("_t"),
        F.nullif("name", F.lit("")).alias("_name"),
        S.map_aspect(F.col("namespace")).alias("_ontology"),
        F.nullif("definition", F.lit("")).alias("_definition"),
    )
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    return df.join(side, F.col("term_id") == F.col("_t"), "left").select(
        *[c for c in df.columns if c not in ("term_name", "ontology", "definition")],
        F.coalesce(blank("term_name"), "_name").alias("term_name"),
        F.coalesce(blank("ontology"), "_ontology").alias("ontology"),
        F.coalesce(blank("definition"), "_definition").alias("definition"),
    )


def first_source(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """J-09: per key, all rows of the first source that has any.

    The winning source per key is a partially aggregated minimum joined back, so a key with many
    rows is never gathered in one task.
    """
    tagged = [s.withColumn("source_rank", F.lit(i)) for i, s in enumerate(sources, start=1)]
    union = tagged[0]
    for other in tagged[1:]:
        union = union.unionByName(other, allowMissingColumns=True)
    best = union.groupBy(*keys).agg(F.min("source_rank").alias("source_rank"))
    return union.join(best, [*keys, "source_rank"], "left_semi")


def request_protein_links(events: DataFrame) -> DataFrame:
    """J-10: one row per (request, protein) link of events whose records are a list of the message
    (a request may hold 400); a request without records links its own protein.
    """
    kind = "array<struct<protein_id:string,sequence:string,sequence_length:int,description:string>>"
    single = F.array(
        F.struct(
            F.col("protein_id"), F.lit(None).cast("string"),
            F.col("sequence_length"), F.lit(None).cast("string"),
        )
    ).cast(kind)
    listed = F.when(F.size("input_records") > 0, F.col("input_records").cast(kind)).otherwise(single)
    item = events.withColumn("_rec", F.explode(listed))
    own = [c for c in events.columns if c not in ("protein_id", "sequence_length", "input_records")]
    linked = item.select(
        *own,
        F.trim("_rec.protein_id").alias("protein_id"),
        F.coalesce("_rec.sequence_length", F.length("_rec.sequence")).alias("sequence_length"),
        F.col("_rec.description").alias("description"),
    )
    return linked.filter(F.coalesce(F.col("protein_id"), F.lit("")) != "")


def link_records(events: DataFrame, records: DataFrame, key: str = "request_id") -> DataFrame:
    """J-10 where the records are a table of their own (key, protein_id, sequence_length): one row
    per link; an event without records links its own protein. Links without an id go.
    """
    cols = [key, "protein_id", "sequence_length"]
    alone = events.join(records.select(key), key, "left_anti").select(*cols)
    linked = records.join(events.select(key), key, "left_semi").select(*cols).unionByName(alone)
    return linked.withColumn("protein_id", F.trim("protein_id")).filter(F.coalesce("protein_id", F.lit("")) != "")


def reconcile_status(bucket_rows: DataFrame, latest: DataFrame) -> DataFrame:
    """J-11: status-bucket rows whose request still has that status."""
    now = latest.select("request_id", F.col("current_status").alias("_now"))
    return bucket_rows.join(now, "request_id").filter(F.col("current_status") == F.col("_now")).drop("_now")


def count_in_minutes(df: DataFrame, minutes: DataFrame, ts: str = "created_at") -> DataFrame:
    """J-12: rows with ``start <= ts < start + 1 minute``, as an equi-join on the truncated minute."""
    counts = df.groupBy(F.date_trunc("minute", ts).alias("window_start")).agg(F.count("*").alias("_n"))
    return minutes.join(counts, "window_start", "left").select(
        "window_start", F.coalesce("_n", F.lit(0)).alias("metric_value")
    )


def count_in_windows(df: DataFrame, windows: DataFrame, ts: str = "created_at") -> DataFrame:
    """J-12 for windows of any start and length, which may overlap: ``windows`` with ``metric_value``,
    the rows with ``window_start <= ts < window_end``.

    Rows are counted per instant and summed up in time order; a window is the sum before its end
    minus the sum before its start, so no row meets a window. Rows without a time count nowhere; a
    window without a bound, or that ends before it starts, holds 0.
    """
    edges = windows.select(F.explode(F.array("window_start", "window_end")).alias("_at"))
    instants = df.select(F.col(ts).alias("_at"), F.lit(1).alias("_n")).unionByName(edges.select("_at", F.lit(0).alias("_n")))
    per_instant = instants.filter(F.col("_at").isNotNull()).groupBy("_at").agg(F.sum("_n").alias("_n"))
    sums = running_totals(per_instant, ["_at"], {"_upto": F.col("_n")}).select("_at", (F.col("_upto") - F.col("_n")).alias("_before"))
    sums = cut_lineage(sums.join(edges.distinct(), "_at", "left_semi"))
    out = windows
    for bound in ("start", "end"):
        side = sums.select(F.col("_at").alias(f"_{bound}_at"), F.col("_before").alias(f"_{bound}"))
        out = out.join(side, F.col(f"window_{bound}") == F.col(f"_{bound}_at"), "left")
    inside = F.greatest(F.coalesce(F.col("_end") - F.col("_start"), F.lit(0)), F.lit(0))
    return out.select(*windows.columns, inside.alias("metric_value"))


def rows_in_windows(df: DataFrame, windows: DataFrame, ts: str = "created_at") -> DataFrame:
    """J-12 as rows: every row of ``df`` with every window that holds its time.

    Both sides are dealt to bins of a quarter of the mean window and meet by an equi-join on the bin; the
    bounds are checked inside it. A row lies in one bin. Windows lie in all bins that they touch,
    six each on average at most, whatever their lengths, so most rows that a window meets are in it. Bins are sorted and
    merged in as many tasks as shuffles have, not where the files of one side are; a window meets the rows of a bin
    one after the other, so what is counted per window stays in the cache.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    fair = windows.filter(F.col("window_start") < F.col("window_end"))
    mean = fair.agg(F.avg(micros("window_end") - micros("window_start"))).first()[0]
    wide = max(1, int(mean or 1) // 4)
    nth = lambda m: F.floor(m / wide)
    bins = F.sequence(nth(micros("window_start")), nth(micros("window_end") - 1))
    dealt = fair.withColumn("_bin", F.explode(bins))
    rows = df.toDF(*[f"_row{i}" for i in range(len(df.columns))])  # both sides may have columns of one name
    at = f"_row{df.columns.index(ts)}"
    inside = (F.col(at) >= F.col("window_start")) & (F.col(at) < F.col("window_end"))
    met = dealt.hint("merge").join(rows.withColumn("_bin", nth(micros(at))), "_bin").filter(inside)
    return met.select(*[F.col(a).alias(b) for a, b in zip(rows.columns, df.columns, strict=True)], *windows.columns)


def selected_edges(edges: DataFrame, terms: DataFrame) -> DataFrame:
    """J-13: edges with both ends selected."""
    chosen = terms.select("term")
    return edges.join(chosen.withColumnRenamed("term", "child"), "child", "left_semi").join(
        chosen.withColumnRenamed("term", "parent"), "parent", "left_semi"
    )


def match_proteins(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """J-14: equi-join on the protein id, ignoring case; the left id is kept."""
    side = right.withColumn("_pid", F.lower("protein_id")).drop("protein_id")
    return left.withColumn("_pid", F.lower("protein_id")).join(side, "_pid", how).drop("_pid")


def per_threshold(df: DataFrame, grid: Sequence[float]) -> DataFrame:
    """J-15: every score once per threshold it reaches."""
    reached = F.filter(F.array(*[F.lit(float(t)) for t in grid]), lambda t: t <= F.col("score"))
    return df.withColumn("threshold", F.explode(reached))


def visible_predictions(predictions: DataFrame, visible: DataFrame) -> DataFrame:
    """J-16: predictions of visible requests."""
    return predictions.join(visible, "request_id", "left_semi")


def compare_results(original: DataFrame, regenerated: DataFrame, metric: str, key: str = "namespace") -> DataFrame:
    """J-17: original and regenerated value side by side, with the difference.

    Both tables hold one row per namespace; the pivot is a conditional maximum.
    """
    both = original.select(key, metric, F.lit("original").alias("_set")).unionByName(
        regenerated.select(key, metric, F.lit("regenerated").alias("_set"))
    )
    pick = lambda name: F.max(F.when(F.col("_set") == name, F.col(metric)))
    wide = both.groupBy(key).agg(pick("original").alias("original"), pick("regenerated").alias("regenerated"))
    return wide.withColumn("difference", F.col("regenerated") - F.col("original"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """U-01: union by name; absent columns are null."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def set_tables(left: DataFrame, right: DataFrame) -> dict[str, DataFrame]:
    """U-03 to U-05 on long set tables (group, member)."""
    return {
        "both": left.intersect(right),
        "either": left.unionByName(right).distinct(),
        "only_left": left.subtract(right),
    }


def set_columns(left: Column, right: Column) -> dict[str, Column]:
    """U-03 to U-05 on array columns of bounded size, sorted."""
    return {
        "both": F.array_sort(F.array_intersect(left, right)),
        "either": F.array_sort(F.array_union(left, right)),
        "only_left": F.array_sort(F.array_except(left, right)),
    }
