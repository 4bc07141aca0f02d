"""Readers for sequence files, ontologies, term tables and evaluation results.

Text readers split files by record separators, so a large file is read by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqloom.functions import payload as P
from seqloom.functions import scalars as S
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import keep_first, number_rows

# File suffixes taken as sequence files.
SEQUENCE_SUFFIXES = ("fa", "faa", "fasta", "fna", "txt")

TERMS = "protein_id STRING, term STRING, aspect STRING"
TAXONOMY = "protein_id STRING, taxon STRING"
IA = "term STRING, ia DOUBLE"
PREDICTIONS = "protein_id STRING, term STRING, score DOUBLE"
GROUND_TRUTH = "protein_id STRING, term STRING"


def _records(spark: SparkSession, path: str | Sequence[str], separator: str, **options: str) -> DataFrame:
    """Text pieces with their file and a position that follows file order inside each split."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.options(lineSep=separator, **options).text(paths)
    return raw.select(
        "value",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    ).withColumn("_row", F.monotonically_increasing_id())


def fasta_records(
    raw: DataFrame, id_mode: str = "token", upper: bool = True, on_empty: str = "keep"
) -> DataFrame:
    """SRC-01 on pieces of text cut at ``\\n>``."""
    text = F.regexp_replace(F.regexp_replace("value", r"\r\n?", "\n"), r"^\s*>", "")
    header = F.trim(F.regexp_extract(text, r"^([^\n]*)", 1))
    body = F.regexp_replace(F.substring(text, F.instr(text, F.lit("\n")), F.length(text)), r"\s+", "")
    sequence = F.when(F.instr(text, F.lit("\n")) > 0, body).otherwise(F.lit(""))
    if upper:
        sequence = F.upper(sequence)
    stem = F.regexp_extract("source_file", r"([^/]+?)(\.[^./]*)?$", 1)
    token = S.accession(header) if id_mode == "accession" else S.first_token(header)
    record = raw.select(
        F.when(token == "", stem).otherwise(token).alias("protein_id"),
        F.trim(F.regexp_replace(header, r"^\S+", "")).alias("description"),
        sequence.alias("sequence"),
        "source_file", "_block", "_row",
        (F.trim(F.regexp_replace("value", r"[\s>]+", "")) != "").alias("_filled"),
    ).filter("_filled")
    if on_empty == "drop":
        record = record.filter("sequence != ''")
    elif on_empty == "error":
        missing = F.concat(F.lit("FASTA record without sequence lines: "), F.col("protein_id"))
        checked = F.when(F.col("sequence") == "", F.raise_error(missing)).otherwise(F.col("sequence"))
        record = record.withColumn("sequence", checked)
    elif on_empty != "keep":
        raise ValueError("on_empty must be keep, drop or error")
    return record


def read_fasta(
    spark: SparkSession,
    path: str | Sequence[str],
    id_mode: str = "token",
    upper: bool = True,
    on_empty: str = "keep",
    last_wins: bool = False,
) -> DataFrame:
    """SRC-01: (protein_id, description, sequence, source_file) of FASTA files.

    ``id_mode`` is ``token`` (first word of the header) or ``accession`` (between the pipes).
    ``last_wins`` keeps the last record of a repeated id.
    """
    rows = fasta_records(_records(spark, path, "\n>"), id_mode, upper, on_empty)
    if last_wins:
        rows = keep_first(rows, ["protein_id"], [F.desc("source_file"), F.desc("_block"), F.desc("_row")])
    return rows.select("protein_id", "description", "sequence", "source_file")


def check_fasta(records: DataFrame) -> DataFrame:
    """SRC-01, whole-file rule: per file, whether every record is valid, with the first message."""
    error = S.sequence_error(F.col("sequence"), "ui")
    broken = F.when(
        error.isNotNull(),
        F.concat(F.lit("FASTA record "), F.col("protein_id"), F.lit(" has an invalid protein sequence.")),
    )
    return records.groupBy("source_file").agg(
        F.count("*").alias("records"), F.count(broken).alias("invalid_records"), F.min(broken).alias("error_message")
    )


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).csv(path, sep="\t", header=False)


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: headerless (protein, term, aspect) table."""
    return _tsv(spark, path, TERMS)


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: headerless (protein, taxon) table."""
    return _tsv(spark, path, TAXONOMY)


def read_ia(spark: SparkSession, path: str) -> DataFrame:
    """SRC-02: headerless (term, information accretion) table."""
    return _tsv(spark, path, IA)


def read_sequence_table(spark: SparkSession, path: str, id_col: str = "protein_id", seq_col: str = "sequence") -> DataFrame:
    """SRC-03: table with a header; tab for .tsv and .tab, else comma; missing columns are an error."""
    tabbed = path.lower().endswith((".tsv", ".tab"))
    table = spark.read.csv(path, sep="\t" if tabbed else ",", header=True)
    missing = [c for c in (id_col, seq_col) if c not in table.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return table.select(
        F.col(id_col).alias("protein_id"),
        S.normalize_sequence(F.coalesce(F.col(seq_col), F.lit(""))).alias("sequence"),
    )


def read_plain_sequences(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """SRC-04: one sequence per file; the id is the file stem."""
    paths = [path] if isinstance(path, str) else list(path)
    whole = spark.read.text(paths, wholetext=True)
    return whole.select(
        F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "").alias("protein_id"),
        S.normalize_sequence(F.col("value")).alias("sequence"),
        F.col("_metadata.file_path").alias("source_file"),
    ).filter("sequence != ''")


def read_sequence_dir(
    spark: SparkSession, path: str, limit: int | None = None, suffixes: Sequence[str] = SEQUENCE_SUFFIXES
) -> DataFrame:
    """SRC-05: all sequence files below a folder, in path order; plain and FASTA files may mix.

    A file that does not start with ``>`` is one plain sequence named after the file. Files are opened once:
    pieces are written to one table, which the passes below read.
    """
    glob = "*.{" + ",".join(x for s in suffixes for x in (s.lower(), s.upper())) + "}"
    raw = cut_lineage(_records(spark, path, "\n>", recursiveFileLookup="true", pathGlobFilter=glob))
    # only the first piece of a file still carries its marker
    marked = F.col("value").rlike(r"^\s*>")
    is_fasta = raw.groupBy("source_file").agg(F.max(marked).alias("_fasta"))
    pieces = raw.join(is_fasta, "source_file")
    records = fasta_records(pieces.filter("_fasta"), "token", True, "drop")
    records = number_rows(records, ["_block", "_row"], ["source_file"], "record_index")
    whole = pieces.filter(~F.col("_fasta")).groupBy("source_file").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_row", "value"))).alias("_pieces")
    )
    plain = whole.select(
        F.regexp_extract("source_file", r"([^/]+?)(\.[^./]*)?$", 1).alias("protein_id"),
        S.normalize_sequence(F.array_join(F.transform("_pieces", lambda x: x["value"]), "\n>")).alias("sequence"),
        "source_file",
        F.lit(1).cast("bigint").alias("record_index"),
    ).filter("sequence != ''")
    both = records.select("protein_id", "sequence", "source_file", "record_index").unionByName(plain)
    out = both.withColumn("record_index", F.col("record_index") - 1)
    return out if limit is None else out.orderBy("source_file", "record_index").limit(limit)


def _unescape(c: Column) -> Column:
    """E-26: text between the first pair of unescaped quotes, with backslash escapes removed.

    Escaped backslashes and quotes are set aside first, so plain substring search finds the end.
    """
    slash, quote = "\u0001", "\u0002"
    text = F.replace(F.replace(c, F.lit("\\\\"), F.lit(slash)), F.lit('\\"'), F.lit(quote))
    closed = F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit(""))) >= 2
    inner = F.substring_index(F.substring(text, F.instr(text, F.lit('"')) + 1, F.length(text)), '"', 1)
    plain = F.regexp_replace(inner, r"\\(.)", "$1")
    return F.when(closed, F.translate(plain, slash + quote, '\\"')).otherwise(F.lit(""))


class Ontology(tuple):
    """(terms, edges)."""

    __slots__ = ()

    @property
    def terms(self) -> DataFrame:
        return self[0]

    @property
    def edges(self) -> DataFrame:
        return self[1]


def read_obo(spark: SparkSession, path: str) -> Ontology:
    """SRC-06: terms(term, name, namespace, definition) and edges(child, parent, rel).

    Files are cut at stanza starts, so fields never leak from one stanza into the next. Obsolete
    terms have no row in ``terms``; only ``is_a`` and ``part_of`` make edges.
    """
    text = F.concat(F.lit("\n"), F.regexp_replace("value", r"\r\n?", "\n"), F.lit("\n"))
    stanzas = (
        _records(spark, path, "\n[").filter(F.col("value").rlike(r"^\[?Term\]"))
        .select(text.alias("t"), "_row")
        .withColumn("term", F.trim(F.regexp_extract("t", r"\nid: ([^\n]*)", 1)))
        .filter("term != ''")
    )
    field = lambda name: F.trim(F.regexp_extract("t", rf"\n{name}: ([^\n]*)", 1))
    terms = stanzas.filter(~F.col("t").rlike(r"\nis_obsolete: true *\n")).select(
        "term",
        field("name").alias("name"),
        field("namespace").alias("namespace"),
        _unescape(F.regexp_extract("t", r"\ndef: ([^\n]*)", 1)).alias("definition"),
    )
    found = lambda pattern: F.regexp_extract_all("t", F.lit(pattern), F.lit(1))
    links = F.concat(
        F.transform(found(r"\nis_a: (\S+)"), lambda p: F.struct(p.alias("parent"), F.lit("is_a").alias("rel"))),
        F.transform(
            found(r"\nrelationship: part_of (\S+)"), lambda p: F.struct(p.alias("parent"), F.lit("part_of").alias("rel"))
        ),
    )
    edges = stanzas.select(F.col("term").alias("child"), F.explode(links).alias("_l")).select(
        "child", "_l.parent", "_l.rel"
    )
    return Ontology((terms, edges.distinct()))


def read_id_list(spark: SparkSession, path: str, name: str = "protein_id") -> DataFrame:
    """SRC-07: first word of every line that is not blank."""
    word = S.first_token(F.col("value"))
    return spark.read.text(path).select(word.alias(name)).filter(F.col(name) != "")


def read_term_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-08: JSON array of term ids with their index."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", "array<string>")).alias("term_index", "term"))


def read_eval_results(spark: SparkSession, sets: Mapping[str, str], pattern: str = "evaluation_*.tsv") -> DataFrame:
    """SRC-10: evaluator tables of several folders, tagged with result set and metric.

    ``_metric`` is ``all`` or the metric named in ``evaluation_best_<metric>.tsv``.
    """
    out = None
    for name, path in sets.items():
        table = spark.read.csv(f"{path.rstrip('/')}/{pattern}", sep="\t", header=True)
        tagged = table.select(
            *[F.col(f"`{c}`").alias(u) for c, u in zip(table.columns, P.dedupe_names(table.columns), strict=True)],
            F.lit(name).alias("_result_set"),
            F.regexp_extract("_metadata.file_path", r"evaluation_(?:best_)?([^/]*)\.tsv", 1).alias("_metric"),
        )
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


SUMMARY = (
    "planned_total_requests BIGINT, planned_total_sequences BIGINT, completed_requests BIGINT, "
    "completed_sequences BIGINT, elapsed_seconds DOUBLE, throughput_rps DOUBLE, "
    "throughput_seq_per_sec DOUBLE, failure_count BIGINT, failure_rate DOUBLE, "
    "status_counts MAP<STRING,BIGINT>, latency_ms STRUCT<avg: DOUBLE, min: DOUBLE, p50_est: DOUBLE, "
    "p95_est: DOUBLE, p99_est: DOUBLE, max: DOUBLE>"
)


def read_summaries(spark: SparkSession, glob: str) -> DataFrame:
    """SRC-11: load-test summaries, flattened to the columns :func:`scale_table` takes."""
    rows = spark.read.schema(SUMMARY).json(glob, multiLine=True)
    return rows.select(
        *[c for c in rows.columns if c != "latency_ms"],
        F.col("latency_ms.p50_est").alias("latency_p50"),
        F.col("latency_ms.p95_est").alias("latency_p95"),
        F.col("latency_ms.p99_est").alias("latency_p99"),
    )


def read_submission(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """SRC-12: (predictions, texts) of a submission file; rows marked ``Text`` are free text."""
    raw = spark.read.text(path).filter(F.trim("value") != "")
    parts = F.split("value", r"\s+", 3)
    split = raw.select(parts.alias("p"))
    is_text = F.get("p", F.lit(1)) == "Text"
    predictions = split.filter(~is_text).select(
        F.get("p", F.lit(0)).alias("protein_id"),
        F.get("p", F.lit(1)).alias("term"),
        F.trim(F.get("p", F.lit(2))).try_cast("double").alias("score"),
    )
    scored = F.regexp_extract(F.get("p", F.lit(2)), r"^(\S+)\s+(.*)$", 2)
    texts = split.filter(is_text).select(
        F.get("p", F.lit(0)).alias("protein_id"),
        F.regexp_extract(F.get("p", F.lit(2)), r"^(\S+)", 1).try_cast("double").alias("score"),
        scored.alias("text"),
    )
    return predictions, texts
