"""Allow and block rules for URLs, by hashed host suffixes and path prefixes.

A rule names a host and the start of a path. Each distinct URL is expanded into the expressions that
a rule could have: every suffix of its host at a label boundary, up to as many labels as some rule
has, with every prefix of its path whose length some rule has. Expressions meet rules in an
equi-join on the first four bytes of their SHA-256; then full digests are compared, and the longest
rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules of the task.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: The verdict where no rule fits.
DEFAULT = "allow"
PREFIX_BYTES = 4


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_table(spark, rules=RULES) -> DataFrame:
    """(rule, rule_verdict, digest, short, path_length); a rule's host ends at its first slash."""
    given = spark.createDataFrame([tuple(r) for r in rules], "rule string, rule_verdict string")
    digest = F.unhex(F.sha2("rule", 256))
    length = F.length("rule") - F.length(F.substring_index("rule", "/", 1))
    return given.select("rule", "rule_verdict", digest.alias("digest"), digest.substr(1, PREFIX_BYTES).alias("short"), length.alias("path_length"))


def labels_of(host: Column) -> Column:
    return F.split(host, r"\.")


def expressions(lengths: list[int], most_labels: int) -> Column:
    """Host suffixes joined with the path prefixes of the given lengths, of columns host and path.

    No rule's host has more than ``most_labels`` labels, so longer suffixes cannot fit one.
    """
    labels = labels_of(F.col("host"))
    first = F.greatest(F.lit(1), F.size(labels) - most_labels + 1)
    suffixes = F.transform(F.sequence(first, F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths])
    prefixes = F.filter(prefixes, lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """The columns of ``pages`` with host, path, rule and verdict in place of any of those names.

    A null url and one without ``://`` have an empty host and path. ``rule`` is null where none fits;
    the verdict is ``default`` then. Of rules that fit, the longest counts, and of one that is both
    allowed and blocked the allowing one. Rows that repeat are all returned; an empty table of rules or pages is fine.
    The lengths of rules' paths are collected: no more values than a URL has characters.
    """
    lengths = sorted(r.path_length for r in rules.select("path_length").distinct().collect())
    most_labels = rules.agg(F.max(F.size(labels_of(F.substring_index("rule", "/", 1))))).first()[0]
    urls = pages.select(F.col(url_col).alias("_url")).distinct()
    parts = urls.select("_url", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    made = parts.select("_url", F.explode(expressions(lengths, most_labels)).alias("expression")) if lengths else parts.select("_url", F.col("host").alias("expression"))
    hashed = made.select("_url", F.unhex(F.sha2("expression", 256)).alias("full"))
    met = hashed.withColumn("short", F.col("full").substr(1, PREFIX_BYTES)).join(rules, "short").filter("full = digest")
    order = F.struct(F.length("rule").alias("length"), "rule", F.when(F.col("rule_verdict") == "allow", 1).otherwise(0).alias("by"), "rule_verdict")
    decided = met.groupBy("_url").agg(F.max(order).alias("top")).select("_url", F.col("top.rule").alias("rule"), F.col("top.rule_verdict").alias("_verdict"))
    kept = pages.select(*[c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "_url", "_verdict")], F.col(url_col).alias("_url"))
    return kept.join(decided, "_url", "left").select(
        *[c for c in kept.columns if c != "_url"],
        host_of(F.col("_url")).alias("host"),
        path_of(F.col("_url")).alias("path"),
        "rule",
        F.coalesce("_verdict", F.lit(default)).alias("verdict"),
    )
