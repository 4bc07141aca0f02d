"""Batched model scoring, ensembles and top-k ranking."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import scalars as S
from seqloom.operators.ordering import join_same, keep_first, number_rows

SCORING_BATCH = 64


def chunk(df: DataFrame, n: int, order: Sequence[str | Column], keys: Sequence[str] = ()) -> DataFrame:
    """W-08: chunk number and place in the chunk, in order, per group (all 0-based)."""
    numbered = number_rows(df, order, keys, "_idx")
    zero_based = F.col("_idx") - 1
    return numbered.select(
        *df.columns,
        F.floor(zero_based / n).alias("chunk_index"),
        (zero_based % n).alias("chunk_position"),
    )


def with_chunk_totals(chunked: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """W-08: chunks per group and rows per chunk, from partially aggregated counts."""
    sizes = chunked.groupBy(*keys, "chunk_index").agg(F.count("*").alias("chunk_size"))
    top = sizes.groupBy(*keys).agg((F.max("chunk_index") + 1).alias("total_chunks"))
    totals = join_same(sizes, top, keys)
    return join_same(chunked, totals, [*keys, "chunk_index"])


def score(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    out_schema: str,
    batch: int = SCORING_BATCH,
    key: str = "protein_id",
) -> DataFrame:
    """M-06: run a supplied model over the rows, ``batch`` at a time, on the executors.

    ``fn`` gets a frame of at most ``batch`` rows and returns frames matching ``out_schema``. If it
    raises, every row of that batch comes out with ``error_code`` and ``error_message`` and null
    results; other batches are unaffected.
    """
    fields = [f.split()[0] for f in out_schema.split(",")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch):
                part = frame.iloc[start : start + batch].reset_index(drop=True)
                try:
                    result = fn(part)[fields].copy()
                    result["error_code"] = None
                    result["error_message"] = None
                except Exception as exc:  # noqa: BLE001 - a broken batch becomes failure rows
                    result = pd.DataFrame({c: [None] * len(part) for c in fields})
                    result[key] = part[key]
                    result["error_code"] = type(exc).__name__
                    result["error_message"] = str(exc)
                yield result

    return df.mapInPandas(run, out_schema + ", error_code string, error_message string")


def normalized_weights(weights: Mapping[str, float], present: Sequence[str]) -> dict[str, float]:
    """M-07: weights of the present branches scaled to one; equal when they add up to nothing."""
    chosen = {b: float(weights.get(b, 0.0)) for b in present}
    total = sum(chosen.values())
    if total <= 0:
        return {b: 1.0 / len(chosen) for b in chosen}
    return {b: w / total for b, w in chosen.items()}


def ensemble(scores: DataFrame, weights: Mapping[str, float], keys: Sequence[str] = ("protein_id", "term")) -> DataFrame:
    """M-07: weighted sum of branch scores per (protein, term); an absent branch counts as 0.

    ``weights`` names the present branches; it is a fixed handful, so it is a literal map.
    """
    scaled = normalized_weights(weights, list(weights))
    table = F.create_map(*[F.lit(x) for pair in scaled.items() for x in pair])
    part = F.coalesce(F.try_element_at(table, F.col("model")), F.lit(0.0)) * F.col("score")
    return scores.groupBy(*keys).agg(F.sum(part).alias("score"))


def with_branches(combined: DataFrame, branches: DataFrame, name: str = "ensemble") -> DataFrame:
    """M-08: ensemble rows followed by the rows of each branch."""
    return combined.withColumn("model", F.lit(name)).unionByName(branches.select("model", *combined.columns))


def top_k(scores: DataFrame, k: int, threshold: float | None = None, keys: Sequence[str] = ("protein_id",),
          tie: str = "term") -> DataFrame:
    """W-01: best ``k`` terms per protein, then the threshold, score rounded to six digits."""
    best = keep_first(scores, keys, [F.desc("score"), F.asc(tie)], k)
    if threshold is not None:
        best = best.filter(F.col("score") >= threshold)
    return best.withColumn("score", F.round("score", 6))


def export_top_k(scores: DataFrame, k: int = 1500, tie: str = "term") -> DataFrame:
    """W-02: best ``k`` terms per protein, positive scores only, at most 1."""
    best = keep_first(scores.filter(F.col("score") > 0), ["protein_id"], [F.desc("score"), F.asc(tie)], k)
    return best.withColumn("score", F.least(F.col("score"), F.lit(1.0)))


def inspect_terms(scores: DataFrame, frequency: DataFrame, ia: DataFrame, degree: DataFrame, k: int = 20) -> DataFrame:
    """W-10: best ``k`` terms per protein with training frequency, accretion and parent count."""
    best = top_k(scores, k)
    return (
        best.join(frequency.select("term", "frequency"), "term", "left")
        .join(ia.select("term", "ia"), "term", "left")
        .join(degree.select("term", "n_parents"), "term", "left")
        .select(
            "protein_id", "term", "score",
            F.coalesce("frequency", F.lit(0)).alias("frequency"),
            F.coalesce("ia", F.lit(1.0)).alias("ia"),
            F.coalesce("n_parents", F.lit(0)).alias("n_parents"),
        )
    )


def normalize_predictions(df: DataFrame) -> DataFrame:
    """M-15, E-31: complete rows, score limited to [0, 1], positive, best first per protein."""
    whole = df.dropna(subset=["protein_id", "term", "score"])
    clipped = whole.withColumn("score", S.clip_score(F.col("score"))).filter(F.col("score") > 0)
    return clipped.orderBy(F.asc("protein_id"), F.desc("score"))
