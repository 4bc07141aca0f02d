"""Writers for predictions, ground truth, lists, reports and keyed JSON events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-01: headerless (protein, term, score) tab table."""
    df.select("protein_id", "term", "score").write.mode(mode).csv(path, sep="\t", header=False)


def write_ground_truth(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-02: headerless distinct (protein, term) tab table."""
    df.select("protein_id", "term").distinct().write.mode(mode).csv(path, sep="\t", header=False)


def write_id_list(df: DataFrame, path: str, column: str = "protein_id", order: Sequence[str | Column] | None = None,
                  mode: str = "overwrite") -> None:
    """SNK-03: one id per line; part files are in order, sorted across tasks."""
    keys = order or [column]
    df.orderBy(*keys).select(F.col(column).cast("string")).write.mode(mode).text(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK-04: comma table with a header."""
    df.write.mode(mode).csv(path, header=True)


def event_messages(df: DataFrame, key: str, topic: str) -> DataFrame:
    """Key, topic and JSON value of every row."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.lit(topic).alias("topic"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )


def send_messages(messages: DataFrame, path: str | None = None, servers: str | None = None) -> None:
    """SNK-05: (key, topic, value) to Kafka, or to packed JSON files per topic when ``path`` is given.

    Messages repeat their field names, so packed files are a fraction of the plain ones.
    """
    if path is not None:
        messages.write.mode("append").partitionBy("topic").json(path, compression="gzip")
    elif servers is not None:
        messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()
    else:
        raise ValueError("give a path or Kafka servers")


def write_events(df: DataFrame, key: str, topic: str, path: str | None = None, servers: str | None = None) -> None:
    """SNK-05: every row as a keyed JSON message."""
    send_messages(event_messages(df, key, topic), path, servers)
