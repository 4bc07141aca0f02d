"""Turning raw JSON messages into typed events, with a dead-letter branch."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions import scalars as S

EVENT_SCHEMA = (
    "request_id STRING, protein_id STRING, sequence STRING, source STRING, event_time STRING, "
    "metadata STRING, checksum STRING"
)


class Parsed(NamedTuple):
    valid: DataFrame
    dead: DataFrame


def validate(df: DataFrame, profile: str = "event", sequence: str = "sequence") -> DataFrame:
    """E-04: adds ``error_message``, the first broken rule or null."""
    return df.withColumn("error_message", S.sequence_error(F.col(sequence), profile))


def event_error(readable: Column, protein_id: Column, sequence: Column) -> Column:
    return (
        F.when(~readable, "malformed JSON")
        .when(protein_id.isNull(), "protein_id is required")
        .when(protein_id == "", S.ID_BLANK)
        .when(sequence.isNull(), "sequence is required")
        .otherwise(S.sequence_error(sequence, "event"))
    )


def _once(df: DataFrame, kept: list[str], *computed: Column) -> DataFrame:
    """``kept`` and computed columns that are worked out once per row."""
    return df.select(*kept, F.inline(F.array(F.struct(*computed))))


def read_messages(raw: DataFrame, value: str = "value") -> DataFrame:
    """Typed columns plus ``error_message`` for every raw message (E-01 to E-04, E-06, E-09, E-10).

    One narrow pass; callers split it by ``error_message``. Missing request ids are derived from
    the message itself, so a replayed task gives the same id again.
    """
    kept = [c for c in raw.columns if c != value]
    text = F.col(value).cast("string")
    # columns of a generator are never replaced by their expressions, so JSON is parsed and text
    # normalised once per row, wherever filters are pushed to
    parsed = _once(
        raw.select(*kept, text.alias("raw_value")),
        [*kept, "raw_value"],
        F.from_json("raw_value", EVENT_SCHEMA).alias("_e"),
        F.coalesce(F.ltrim(F.get_json_object("raw_value", "$")).startswith("{"), F.lit(False)).alias("_readable"),
    )
    clean = _once(
        parsed,
        [*kept, "raw_value", "_readable"],
        F.coalesce("_e.request_id", F.sha2("raw_value", 256)).alias("request_id"),
        S.trimmed_id(F.col("_e.protein_id")).alias("protein_id"),
        S.normalize_sequence(F.col("_e.sequence")).alias("sequence"),
        F.coalesce("_e.source", F.lit("api")).alias("source"),
        S.parse_ts(F.col("_e.event_time"), "+00:00").alias("event_time"),
        F.coalesce("_e.metadata", F.lit("{}")).alias("metadata"),
        F.col("_e.checksum").alias("_checksum"),
    )
    return clean.select(
        *kept,
        "request_id", "protein_id", "sequence", "source", "event_time", "metadata",
        S.checksum(F.col("sequence"), F.col("_checksum")).alias("checksum"),
        "raw_value",
        event_error(F.col("_readable"), F.col("protein_id"), F.col("sequence")).alias("error_message"),
    )


def parse_events(raw: DataFrame, value: str = "value") -> Parsed:
    """E-01: (valid events, dead letters). Every input row lands in exactly one of them."""
    rows = read_messages(raw, value)
    bad = F.col("error_message").isNotNull()
    valid = rows.filter(~bad).drop("error_message", "raw_value")
    return Parsed(valid, dead_letters(rows.filter(bad)))


def dead_letters(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """ST-02: dead-letter form of rejected messages; columns ``keep`` go along."""
    malformed = F.col("error_message") == "malformed JSON"
    return rows.select(
        F.lit("unknown").alias("request_id"),
        F.lit(None).cast("string").alias("protein_id"),
        F.now().alias("failed_at"),
        F.lit("spark_validation").alias("stage_name"),
        F.when(malformed, "JSONDecodeError").otherwise("ValidationError").alias("error_code"),
        "error_message",
        F.lit(False).alias("retryable"),
        F.to_json(F.struct("raw_value")).alias("payload"),
        *keep,
    )


def request_parameters(events: DataFrame, default_top_k: int = 20) -> DataFrame:
    """E-09, E-10: ``top_k`` and ``threshold`` columns from the metadata JSON."""
    kept = events.columns
    read = events.select(
        "*",
        F.try_variant_get(F.try_parse_json("metadata"), "$.top_k", "variant").alias("_k"),
        F.get_json_object("metadata", "$.threshold").alias("_t"),
    )
    return read.select(
        *kept,
        S.top_k_of_json(F.col("_k"), default_top_k).alias("top_k"),
        S.coerce_threshold(F.col("_t")).alias("threshold"),
    )
