"""Row numbers and running totals over groups that may not fit in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.lineage import cut_lineage

# Bytes of the input, as Spark estimates them, that one range gets about; ranges are limited in number.
RANGE_BYTES, MOST_RANGES = 128 << 20, 20_000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null. Without keys ``right`` is one row, whose values
    are added as scalar subqueries.
    """
    if not keys:
        return left.withColumns({c: right.select(c).scalar() for c in right.columns})
    names = {k: f"_same_{k}" for k in keys}
    side = right.withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(side, same).drop(*names.values())


def _ranges(df: DataFrame) -> int:
    """How many ranges to order ``df`` in: the session's partitions, more where the input is large."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(MOST_RANGES, size // RANGE_BYTES))


def running_totals(
    df: DataFrame,
    order: Sequence[str | Column],
    totals: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums of ``totals`` per group, in ``order`` (which must be unique).

    Rows are range partitioned on (keys, order), summed inside each range, and every range is
    shifted by the sums of the ranges before it. No task holds more than one range.
    """
    order = [_col(c) for c in order]
    slots = _ranges(df)
    parts = {n: f"_running_{n}" for n in totals}
    placed = cut_lineage(
        df.select("*", *[v.alias(parts[n]) for n, v in totals.items()])
        .repartitionByRange(slots, *[F.col(k) for k in keys], *order)
        .withColumn("_range", F.spark_partition_id())
    )
    inner = Window.partitionBy(*keys, "_range").orderBy(*order)
    inner = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = placed.select(
        *df.columns, "_range", *[F.sum(parts[n]).over(inner).alias(n) for n in totals]
    )
    earlier = Window.partitionBy(*keys).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(*keys, "_range")
        .agg(*[F.sum(p).alias(p) for p in parts.values()])
        .select(
            *[F.col(k).alias(f"_group_key{i}") for i, k in enumerate(keys)],
            F.col("_range").alias("_range_key"),
            *[F.coalesce(F.sum(p).over(earlier), F.lit(0)).alias(f"_shift{p}") for p in parts.values()],
        )
    )
    same = [F.col(k).eqNullSafe(F.col(f"_group_key{i}")) for i, k in enumerate(keys)]
    same.append(F.col("_range") == F.col("_range_key"))
    joined = within.join(shifts, reduce(lambda a, b: a & b, same))
    return joined.select(
        *df.columns, *[(F.col(n) + F.col(f"_shift{parts[n]}")).alias(n) for n in totals]
    )


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    keys: Sequence[str] = (),
    name: str = "row_index",
) -> DataFrame:
    """Add a 1-based position per group; ``order`` must be unique inside a group."""
    return running_totals(df, order, {name: F.lit(1).cast("bigint")}, keys)


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key. Spark prunes each task to ``n`` rows per key before the shuffle,
    so a hot key sends at most ``n`` rows per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")
