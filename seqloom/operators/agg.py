"""Counting, distribution and ranking aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import join_same, keep_first, number_rows, running_totals



def value_counts(df: DataFrame, c: str, n: int | None = None) -> DataFrame:
    """A-01: counts and shares per value, most frequent first, ties by value."""
    counts = df.groupBy(c).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    shared = counts.withColumn("share", F.col("n").cast("double") / total.cast("double"))
    ordered = shared.orderBy(F.desc("n"), F.asc(c))
    return ordered if n is None else ordered.limit(n)


def nunique(df: DataFrame, c: str, keys: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """A-02: distinct values per group, or overall without keys.

    The exact form deduplicates (key, value) pairs before counting, so a hot key is counted from
    many tasks.
    """
    if approximate:
        return df.groupBy(*keys).agg(F.approx_count_distinct(c).alias("n_unique"))
    return df.select(*keys, c).filter(F.col(c).isNotNull()).distinct().groupBy(*keys).agg(F.count("*").alias("n_unique"))


def group_size(df: DataFrame, *keys: str) -> DataFrame:
    """A-03."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def value_ranks(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct values per group with ``upto``, the number of rows at or below each.

    Equal values are folded before anything is ordered, so a value that fills a third of the rows
    is one row here.
    """
    folded = cut_lineage(df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count("*").alias("_n")))
    return running_totals(folded, [c], {"upto": F.col("_n")}, keys)


def _at_rank(value: Column, rank: Column) -> Column:
    return F.min(F.when(F.col("upto") > rank, value))


def quantiles(df: DataFrame, c: str, ratios: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles per group."""
    ranks = value_ranks(df, c, keys)
    sizes = ranks.groupBy(*keys).agg(F.max("upto").alias("_size"))
    ranked = join_same(ranks, sizes, keys)
    value = F.col(c).cast("double")
    parts = []
    for name, ratio in ratios.items():
        place = (F.col("_size") - 1) * F.lit(float(ratio))
        parts += [
            _at_rank(value, F.floor(place)).alias(f"_lo_{name}"),
            _at_rank(value, F.ceil(place)).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_w_{name}"),
        ]
    spread = ranked.groupBy(*keys).agg(*parts)
    return spread.select(
        *keys,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in ratios
        ],
    )


def nearest_ranks(df: DataFrame, c: str, ratios: dict[str, float], keys: Sequence[str] = ()) -> DataFrame:
    """Value at sorted position ``round((n - 1) * ratio)``, halves to even."""
    ranks = value_ranks(df, c, keys)
    sizes = ranks.groupBy(*keys).agg(F.max("upto").alias("_size"))
    ranked = join_same(ranks, sizes, keys)
    place = lambda r: F.bround((F.col("_size") - 1) * F.lit(float(r)))
    return ranked.groupBy(*keys).agg(*[_at_rank(F.col(c), place(r)).alias(n) for n, r in ratios.items()])


def describe(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """A-04: count, mean, sample deviation, min, quartiles, max."""
    value = F.col(c).cast("double")
    basic = df.groupBy(*keys).agg(
        F.count(c).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    quarts = quantiles(df, c, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, keys)
    return join_same(basic, quarts, keys)


def median_of(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """A-11: exact median per group."""
    return quantiles(df, c, {"median": 0.5}, keys)


def histogram(df: DataFrame, c: str, bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """A-05, A-42: equal-width counts between minimum and maximum, last bin closed, empty bins kept.

    With keys, all groups share the same edges. A single value sits in a unit-wide range.
    """
    value = F.col(c).cast("double")
    low0 = df.agg(F.min(value)).scalar()
    high0 = df.agg(F.max(value)).scalar()
    flat = low0 == high0
    low, high = F.when(flat, low0 - 0.5).otherwise(low0), F.when(flat, high0 + 0.5).otherwise(high0)
    width = (high - low) / F.lit(float(bins))
    index = F.least(F.floor((value - low) / width), F.lit(bins - 1)).cast("int")
    counted = df.filter(value.isNotNull()).groupBy(*keys, index.alias("bin")).agg(F.count("*").alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if keys:
        grid = df.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counted, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (low + F.col("bin") * width).alias("low"),
        (low + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def histogram_edges(df: DataFrame, c: str, edges: Sequence[float | Column]) -> DataFrame:
    """A-06: counts between given edges; the last edge is closed, values outside are dropped."""
    value = F.col(c)
    bounds = [e if isinstance(e, Column) else F.lit(e) for e in edges]
    last = len(bounds) - 2
    case = None
    for i in range(last + 1):
        inside = (value >= bounds[i]) & ((value <= bounds[i + 1]) if i == last else (value < bounds[i + 1]))
        case = F.when(inside, i) if case is None else case.when(inside, i)
    counted = df.groupBy(case.alias("bin")).agg(F.count("*").alias("n")).filter("bin is not null")
    grid = df.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("bin"))
    return grid.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def mode_by(df: DataFrame, key: str, c: str) -> DataFrame:
    """A-07: most frequent value per group, smallest on a tie; folded before the second shuffle."""
    votes = df.filter(F.col(c).isNotNull()).groupBy(key, c).agg(F.count("*").alias("_n"))
    return votes.groupBy(key).agg(F.min_by(c, F.struct(-F.col("_n"), F.col(c))).alias("mode"))


def first_by(df: DataFrame, key: str, c: str, position: str) -> DataFrame:
    """A-08: first value per group in input order."""
    return df.groupBy(key).agg(F.min_by(c, position).alias("first"))


def sets_by(df: DataFrame, key: str, c: str) -> DataFrame:
    """A-09: set of values per group, one row per member.

    Kept long on purpose: a group holding most of the rows stays spread over tasks, and set
    operations on such tables are plain intersect, union and except.
    """
    return df.select(key, F.col(c).alias("member")).distinct()


def mean_ia_by_aspect(ann: DataFrame, ia: DataFrame) -> DataFrame:
    """A-10: mean information accretion per aspect; terms without a value are ignored."""
    folded = ann.groupBy("aspect", "term").agg(F.count("*").alias("_n"))
    joined = folded.join(ia, "term", "left").filter(F.col("ia").isNotNull())
    return joined.groupBy("aspect").agg(
        (F.sum(F.col("ia") * F.col("_n")) / F.sum("_n")).alias("mean_ia"), F.sum("_n").alias("n_rows")
    )


def letter_counts(df: DataFrame, c: str = "sequence") -> DataFrame:
    """A-12: occurrences of every character; tasks pre-aggregate, so few rows are shuffled."""
    letters = df.select(F.explode(F.split(c, "")).alias("letter")).filter("letter != ''")
    return letters.groupBy("letter").agg(F.count("*").alias("n"))


def kmers(df: DataFrame, key: str, c: str, k: int = 3) -> DataFrame:
    """E-22: k-mer counts per text."""
    from seqloom.functions.scalars import kmer_list

    return df.select(key, F.explode(kmer_list(F.col(c), k)).alias("kmer")).groupBy(key, "kmer").agg(F.count("*").alias("n"))


def long_tail(df: DataFrame, c: str) -> DataFrame:
    """A-13: rank of every value by frequency, with log10(count + 1)."""
    counts = cut_lineage(df.groupBy(c).agg(F.count("*").alias("n")))
    ranked = number_rows(counts, [F.desc("n"), F.asc(c)], name="rank")
    return ranked.withColumn("log_count", F.log10(F.col("n") + 1))


def best_by_metric(df: DataFrame, metric: str, keys: Sequence[str], position: str, higher: bool = True) -> DataFrame:
    """A-31: best row per group; the first row wins a tie; rows without the metric are ignored."""
    value = F.desc(metric) if higher else F.asc(metric)
    found = df.filter(F.col(metric).isNotNull())
    return keep_first(found, keys, [value, F.asc(position)]).withColumn("selected_metric", F.lit(metric))


def metric_pivot(df: DataFrame, metric: str, namespaces: Sequence[str], higher: bool = True,
                 row: str = "method", column: str = "namespace") -> DataFrame:
    """A-32: methods by namespaces; the listed namespaces save the scan that would find them."""
    pick = F.max if higher else F.min
    return df.groupBy(row).pivot(column, list(namespaces)).agg(pick(metric))


def overall_score(best: DataFrame, metric: str, key: str = "method") -> DataFrame:
    """A-33: mean over namespaces, best first."""
    return best.groupBy(key).agg(F.avg(metric).alias("overall_mean")).orderBy(F.desc("overall_mean"), F.asc(key))


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """A-34."""
    return df.unpivot(list(ids), list(values), "metric", "value")
