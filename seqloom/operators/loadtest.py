"""Load-test result analysis, request-log rates and data scaling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.agg import nearest_ranks
from seqloom.operators.ordering import join_same, number_rows, running_totals


# Histogram bucket bounds in seconds, rate window, failed examples kept.
LATENCY_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0, 30.0, 60.0)
RATE_WINDOW_MINUTES = 5
FAILED_EXAMPLES = 5
MIN_RATE = 0.001
LATENCY_SAMPLES = 200_000


def _rate(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def bench_summary(results: DataFrame, planned_requests: int, planned_sequences: int, elapsed: float,
                  order: str = "seq") -> DataFrame:
    """A-27: one row with totals, rates, latency ranks, status counts and failed examples.

    ``results``: request_label, record_count, status, error, latency_ms and the order column. An
    empty or missing error means success.
    """
    seconds = F.lit(max(float(elapsed), 0.001))
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    totals = results.agg(
        F.count("*").alias("completed_requests"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("completed_sequences"),
        F.coalesce(F.sum(failed.cast("bigint")), F.lit(0)).alias("failure_count"),
        F.coalesce(F.avg("latency_ms"), F.lit(0.0)).alias("latency_avg"),
        F.coalesce(F.min("latency_ms"), F.lit(0.0)).alias("latency_min"),
        F.coalesce(F.max("latency_ms"), F.lit(0.0)).alias("latency_max"),
    )
    ranks = nearest_ranks(results, "latency_ms", {"latency_p50": 0.5, "latency_p95": 0.95, "latency_p99": 0.99})
    per_status = results.groupBy("status").agg(F.count("*").alias("n"))
    statuses = per_status.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("status", "n")))))
    first = results.filter(failed).orderBy(order).limit(FAILED_EXAMPLES)
    sample = F.transform(F.array_sort(F.collect_list(F.struct(order, "request_label", "error"))),
                         lambda e: F.struct(e["request_label"], e["error"]))
    examples = first.agg(sample)
    return join_same(totals, ranks, ()).select(
        F.lit(planned_requests).cast("bigint").alias("planned_total_requests"),
        F.lit(planned_sequences).cast("bigint").alias("planned_total_sequences"),
        "completed_requests",
        "completed_sequences",
        seconds.alias("elapsed_seconds"),
        (F.col("completed_requests") / seconds).alias("throughput_rps"),
        (F.col("completed_sequences") / seconds).alias("throughput_seq_per_sec"),
        "failure_count",
        _rate(F.col("failure_count"), F.col("completed_requests")).alias("failure_rate"),
        "latency_avg", "latency_min", "latency_p50", "latency_p95", "latency_p99", "latency_max",
        statuses.scalar().alias("status_counts"),
        examples.scalar().alias("failed_examples"),
    )


def bench_checkpoints(results: DataFrame, every: int, position: str = "seq", elapsed: str = "elapsed_seconds") -> DataFrame:
    """A-28: cumulative counts and rates after every ``every``-th result (positions start at 1).

    Rows are summed per block first; only block totals are accumulated.
    """
    failed = F.coalesce(F.col("error"), F.lit("")) != ""
    blocks = results.groupBy(F.ceil(F.col(position) / every).alias("block")).agg(
        F.count("*").alias("_n"),
        F.sum("record_count").alias("_s"),
        F.sum(failed.cast("bigint")).alias("_f"),
        F.max_by(elapsed, position).alias("_t"),
    )
    grown = running_totals(
        blocks, ["block"],
        {"completed_requests": F.col("_n"), "completed_sequences": F.col("_s"), "failure_count": F.col("_f")},
    )
    seconds = F.greatest(F.col("_t").cast("double"), F.lit(0.001))
    whole = grown.filter(F.col("completed_requests") == F.col("block") * every)
    return whole.select(
        "completed_requests",
        "completed_sequences",
        seconds.alias("elapsed_seconds"),
        (F.col("completed_requests") / seconds).alias("throughput_rps"),
        (F.col("completed_sequences") / seconds).alias("throughput_seq_per_sec"),
        "failure_count",
        _rate(F.col("failure_count"), F.col("completed_requests")).alias("failure_rate"),
    )


def approx_latency(results: DataFrame, c: str = "latency_ms", accuracy: int = 10000) -> DataFrame:
    """A-29: percentiles from a mergeable sketch of bounded size."""
    p = lambda r: F.percentile_approx(c, F.lit(r), F.lit(accuracy))
    return results.agg(
        p(0.5).alias("p50_est"), p(0.95).alias("p95_est"), p(0.99).alias("p99_est"), F.count(c).alias("seen")
    )


def sampled_latency(results: DataFrame, key: str, c: str = "latency_ms", size: int = LATENCY_SAMPLES, seed: int = 42) -> DataFrame:
    """A-29: percentiles of a seeded sample of at most ``size`` values, and how many were seen.

    The sample is the ``size`` rows with the smallest hashes of seed and ``key``: samples of parts merge
    into the sample of the whole, so the result does not depend on order, tasks or retries.
    """
    values = results.filter(F.col(c).isNotNull()).select(c, F.sha2(F.concat_ws(":", F.lit(seed), key), 256).alias("_draw"))
    sample = values.orderBy("_draw", c).limit(size)
    ranks = nearest_ranks(sample, c, {"p50_est": 0.5, "p95_est": 0.95, "p99_est": 0.99})
    return ranks.withColumn("seen", values.select(F.count("*")).scalar())


def scale_table(summaries: DataFrame) -> DataFrame:
    """A-30: one rounded row per summary, by planned requests."""
    two = lambda c: F.round(F.col(c).cast("double"), 2)
    return summaries.select(
        F.col("planned_total_requests").cast("bigint").alias("requests"),
        two("throughput_rps").alias("throughput_rps"),
        F.round(F.col("failure_rate") * 100.0, 4).alias("failure_rate_pct"),
        two("latency_p95").alias("p95_ms"),
        two("latency_p99").alias("p99_ms"),
    ).orderBy("requests")


def _sliding(counts: DataFrame) -> DataFrame:
    """Minute counts to every five-minute window (stepping one minute) that contains them."""
    ends = F.sequence(F.lit(0), F.lit(RATE_WINDOW_MINUTES - 1))
    shifted = counts.withColumn("_back", F.explode(ends))
    return shifted.withColumn(
        "window_start", F.col("_minute") - F.make_dt_interval(mins=F.col("_back"))
    ).drop("_back", "_minute")


def rate_by_path(log: DataFrame, ts: str = "ts") -> DataFrame:
    """A-39: requests per second and path over sliding five-minute windows.

    Rows are counted per minute before they are spread over the windows.
    """
    counts = log.groupBy("path", F.date_trunc("minute", ts).alias("_minute")).agg(F.count("*").alias("_n"))
    seconds = RATE_WINDOW_MINUTES * 60.0
    return _sliding(counts).groupBy("path", "window_start").agg((F.sum("_n") / seconds).alias("rate"))


def error_ratio(log: DataFrame, ts: str = "ts") -> DataFrame:
    """A-40: share of 5xx responses per sliding window; the divisor is at least 0.001 per second."""
    bad = ((F.col("status") >= 500) & (F.col("status") < 600)).cast("bigint")
    counts = log.groupBy(F.date_trunc("minute", ts).alias("_minute")).agg(F.count("*").alias("_n"), F.sum(bad).alias("_b"))
    seconds = RATE_WINDOW_MINUTES * 60.0
    sums = _sliding(counts).groupBy("window_start").agg(F.sum("_n").alias("_n"), F.sum("_b").alias("_b"))
    return sums.select(
        "window_start",
        ((F.col("_b") / seconds) / F.greatest(F.col("_n") / seconds, F.lit(MIN_RATE))).alias("error_ratio"),
    )


def bucket_quantile(log: DataFrame, q: float = 0.95, keys: Sequence[str] = ("path",), c: str = "duration_s",
                    bounds: Sequence[float] = LATENCY_BUCKETS) -> DataFrame:
    """A-41: quantile from histogram buckets, linear inside a bucket.

    Values beyond the last bound report that bound. All bucket counts of a group are one
    aggregation row, so no window is needed.
    """
    counted = log.groupBy(*keys).agg(
        F.count(c).alias("_all"),
        *[F.sum((F.col(c) <= b).cast("bigint")).alias(f"_le{i}") for i, b in enumerate(bounds)],
    )
    rank = F.lit(q) * F.col("_all")
    out = F.lit(float(bounds[-1]))
    for i in reversed(range(len(bounds))):
        low = F.lit(float(bounds[i - 1]) if i else 0.0)
        before = F.col(f"_le{i - 1}") if i else F.lit(0)
        inside = F.col(f"_le{i}") - before
        value = low + (F.lit(float(bounds[i])) - low) * F.coalesce(F.try_divide(rank - before, inside), F.lit(0.0))
        out = F.when(F.col(f"_le{i}") >= rank, value).otherwise(out)
    return counted.select(*keys, F.when(F.col("_all") > 0, out).alias("quantile"))


def scale_up(df: DataFrame, n: int | Column, order: Sequence[str], key: str = "protein_id") -> DataFrame:
    """X-01: cycle through the base rows until there are ``n``; round r >= 2 gets suffix ``__r{r}``.

    Each base row works out its own copies, so nothing is joined or shuffled for them.
    """
    numbered = number_rows(df, order, name="_i").withColumn("_i", F.col("_i") - 1)
    size = df.agg(F.count("*")).scalar()
    wanted = n if isinstance(n, Column) else F.lit(n)
    copies = F.floor((wanted - 1 - F.col("_i")) / size) + 1
    rounds = F.when(copies > 0, F.sequence(F.lit(1).cast("bigint"), copies)).otherwise(
        F.array().cast("array<bigint>")
    )
    spread = numbered.withColumn("_round", F.explode(rounds))
    name = F.when(F.col("_round") == 1, F.col(key)).otherwise(
        F.concat(F.col(key).cast("string"), F.lit("__r"), F.col("_round").cast("string"))
    )
    return spread.select(
        (F.col("_i") + (F.col("_round") - 1) * size).alias("sequence_index"),
        *[name.alias(c) if c == key else F.col(c) for c in df.columns],
    )


def to_requests(df: DataFrame, m: int, index: str = "sequence_index", key: str = "protein_id") -> DataFrame:
    """X-02: requests of ``m`` consecutive records (index from 0, request numbers from 1)."""
    number = (F.floor(F.col(index) / m) + 1).alias("request_index")
    grouped = df.groupBy(number).agg(F.array_sort(F.collect_list(F.struct(index, key))).alias("_rows"))
    return grouped.select(
        "request_index",
        F.size("_rows").cast("bigint").alias("record_count"),
        F.transform("_rows", lambda r: r[key]).alias("protein_ids"),
    )

