"""Column expressions on identifiers, sequences, timestamps and request parameters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Alphabets, limits and message texts that results must match.
STANDARD_LETTERS = "ACDEFGHIKLMNPQRSTVWY"
ALL_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MAX_EVENT_LETTERS = 20000
MIN_UI_LETTERS = 10
MAX_UI_LETTERS = 10000
HYDROPHOBIC = "AILMFWYV"
POLAR = "STNQ"
CHARGED = "DEKR"
RESIDUE_MASS = 110
EVENT_BLANK = "sequence must not be blank"
EVENT_LONG = "sequence length exceeds 20000 amino acids"
EVENT_LETTERS = "sequence contains invalid amino-acid characters"
ID_BLANK = "protein_id must not be blank"
REQUIRED = "Sequence is required."
UI_LETTERS = "Sequence can only contain standard amino acid symbols: ACDEFGHIKLMNPQRSTVWY."
UI_SHORT = "Sequence is too short for a useful inference request."
UI_LONG = "Sequence is too long for the current UI limit."
APP_ZONE = "+07:00"
# white space as the text rules mean it: every Unicode space, not only the ASCII ones
WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"
ASPECT_CODES = {
    "F": "MF", "P": "BP", "C": "CC",
    "MF": "MF", "BP": "BP", "CC": "CC",
    "molecular_function": "MF", "biological_process": "BP", "cellular_component": "CC",
}


def trimmed_id(c: Column) -> Column:
    """E-02: identifier without surrounding white space."""
    return F.regexp_replace(c, f"^{WHITE}|{WHITE}$", "")


def normalize_sequence(c: Column) -> Column:
    """E-03: all white space removed, upper case."""
    return F.upper(F.regexp_replace(c, WHITE, ""))


def invalid_symbols(c: Column) -> Column:
    """E-05: sorted distinct letters outside the standard twenty.

    Valid letters are stripped before splitting, so a clean text never becomes an array.
    """
    rest = F.regexp_replace(c, f"[{STANDARD_LETTERS}]", "")
    return F.when(rest == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.array_distinct(F.split(rest, "")))
    )


def sequence_error(c: Column, profile: str = "event") -> Column:
    """E-04: message of the first broken rule for a normalised sequence, null when valid."""
    size = F.length(c)
    if profile == "event":
        return (
            F.when(c.isNull() | (c == ""), EVENT_BLANK)
            .when(size > MAX_EVENT_LETTERS, EVENT_LONG)
            .when(~c.rlike("^[A-Z]+$"), EVENT_LETTERS)
        )
    if profile == "api":
        return F.when(c.isNull() | (c == ""), REQUIRED).when(
            ~c.rlike(f"^[{STANDARD_LETTERS}]+$"),
            F.concat(
                F.lit("Sequence contains unsupported symbols: "),
                F.array_join(invalid_symbols(c), ", "),
                F.lit("."),
            ),
        )
    if profile == "ui":
        return (
            F.when(c.isNull() | (c == ""), REQUIRED)
            .when(~c.rlike(f"^[{STANDARD_LETTERS}]+$"), UI_LETTERS)
            .when(size < MIN_UI_LETTERS, UI_SHORT)
            .when(size > MAX_UI_LETTERS, UI_LONG)
        )
    raise ValueError(f"unknown profile {profile!r}")


def checksum(sequence: Column, supplied: Column | None = None) -> Column:
    """E-06: SHA-256 hex; a supplied checksum is kept."""
    computed = F.sha2(sequence, 256)
    return computed if supplied is None else F.coalesce(supplied, computed)


def shard(c: Column, n: int = 32) -> Column:
    """E-07: SHA-256 of ``c``, read as one integer, modulo ``n``."""
    if not 0 < n <= 2**30:
        raise ValueError("n must be between 1 and 2**30")
    digest = F.sha2(c, 256)
    words = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(8)]
    if n & (n - 1) == 0:
        return F.pmod(words[-1], F.lit(n)).cast("int")
    rest = F.lit(0).cast("bigint")
    for word in words:
        rest = F.pmod(rest * F.lit(2**32) + word, F.lit(n).cast("bigint"))
    return rest.cast("int")


def sorted_json(metadata: Column) -> Column:
    """JSON of a string map with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(metadata))))


def feature_hash(protein_id: Column, sequence: Column, metadata: Column) -> Column:
    """E-08: SHA-256 over id, sequence and metadata (a string map, keys sorted)."""
    return F.sha2(F.concat_ws(":", protein_id, sequence, sorted_json(metadata)), 256)


def coerce_top_k(c: Column, default: int = 20, low: int = 1, high: int = 500) -> Column:
    """E-09: integer text clamped to [low, high]; anything else is the default, unclamped."""
    text = F.trim(c.cast("string"))
    whole = text.rlike(r"^[+-]?\d+$")
    number = text.try_cast("bigint")
    clamped = F.least(F.greatest(number, F.lit(low)), F.lit(high))
    beyond = F.when(text.startswith("-"), F.lit(low)).otherwise(F.lit(high))
    return (
        F.when(whole & number.isNotNull(), clamped).when(whole, beyond).otherwise(F.lit(default)).cast("int")
    )


def top_k_of_json(value: Column, default: int = 20, low: int = 1, high: int = 500) -> Column:
    """E-09 of a JSON value (a variant): numbers lose their fraction, true and false are 1 and 0, text
    must be an integer; the result is clamped. Anything else is the default.
    """
    kind = F.schema_of_variant(value)
    number = F.try_variant_get(value, "$", "double")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    kept = F.least(F.greatest(F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "int")).otherwise(whole), F.lit(low)), F.lit(high))
    text = coerce_top_k(F.try_variant_get(value, "$", "string"), default, low, high)
    return F.when(kind == "STRING", text).when(number.isNotNull() | (kind == "BOOLEAN"), kept).otherwise(F.lit(default)).cast("int")


def coerce_threshold(c: Column) -> Column:
    """E-10: number clamped to [0, 1]; missing, unreadable or NaN is null."""
    number = c.try_cast("double")
    return F.when(
        number.isNotNull() & ~F.isnan(number), F.least(F.greatest(number, F.lit(0.0)), F.lit(1.0))
    )


def parse_ts(c: Column, zone: str = APP_ZONE, now: Column | None = None) -> Column:
    """E-11: ISO text to a timestamp; without an offset it is local to ``zone``; missing is now."""
    text = F.trim(c)
    dated = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.concat(text, F.lit("T00:00:00"))).otherwise(text)
    zoned = dated.rlike(r"(?i)(Z|[+-]\d{2}(:?\d{2}(:?\d{2})?)?)$") & dated.rlike("[T ]")
    full = F.when(zoned, dated).otherwise(F.concat(dated, F.lit(zone)))
    present = F.now() if now is None else now
    return F.when(c.isNull() | (c == ""), present).otherwise(F.try_to_timestamp(full))


def local_time(ts: Column, zone: str = APP_ZONE) -> Column:
    """Wall-clock time of ``zone`` (the session zone is UTC)."""
    return F.from_utc_timestamp(ts, zone)


def local_day(ts: Column, zone: str = APP_ZONE) -> Column:
    return F.to_date(local_time(ts, zone))


def bucket_keys(created_at: Column, status: Column, username: Column, protein_id: Column,
                zone: str = APP_ZONE) -> dict[str, Column]:
    """E-12: local day, ``day#status``, ``day#user`` and lower-case protein keys."""
    day = local_day(created_at, zone)
    text = F.date_format(day, "yyyy-MM-dd")
    return {
        "request_date": day,
        "status_bucket": F.concat_ws("#", text, F.lower(status)),
        "username_bucket": F.concat_ws("#", text, username),
        "protein_bucket": F.lower(protein_id),
    }


def accession(header: Column) -> Column:
    """E-13: accession between the first two pipes of the first token, else that token."""
    token = F.regexp_extract(F.regexp_replace(header, r"^\s*>", ""), r"^\s*(\S+)", 1)
    middle = F.regexp_extract(token, r"^[^|]*\|([^|]+)", 1)
    return F.when(middle != "", middle).otherwise(token)


def first_token(c: Column) -> Column:
    return F.regexp_extract(c, r"^\s*(\S+)", 1)


def map_aspect(c: Column) -> Column:
    """E-15: aspect or namespace code to MF, BP or CC, else null."""
    table = F.create_map(*[F.lit(x) for pair in ASPECT_CODES.items() for x in pair])
    return F.try_element_at(table, c)


def confidence_summary(score_map: Column) -> Column:
    """E-16: ``top_terms=N;max_score=x`` of the score map of a message."""
    return confidence_text(F.size(score_map), F.array_max(F.map_values(score_map)))


def confidence_text(n_terms: Column, best: Column) -> Column:
    """E-16 from a count and a maximum, which Spark aggregates without a list."""
    return F.format_string("top_terms=%d;max_score=%.6f", n_terms, F.coalesce(best, F.lit(0.0)))


def confidence_sentence(protein_id: Column, sequence: Column, top_term: Column, top_score: Column) -> Column:
    """E-16: sentence form; ``top_term`` is null when nothing was returned."""
    letters = F.length(sequence)
    return F.when(
        top_term.isNull(),
        F.format_string(
            "CAFA-6 Modal endpoint processed %s with %d amino acids but returned no GO terms.",
            protein_id, letters,
        ),
    ).otherwise(
        F.format_string(
            "CAFA-6 Modal endpoint processed %s with %d amino acids; top GO term is %s with score %.3f.",
            protein_id, letters, top_term, top_score,
        )
    )


def batch_label(n_proteins: Column, any_id: Column) -> Column:
    """E-17: the id of a single protein, else ``batch:N-proteins``."""
    return F.when(n_proteins == 1, any_id).otherwise(
        F.concat(F.lit("batch:"), n_proteins.cast("string"), F.lit("-proteins"))
    )


def is_batch_label(c: Column) -> Column:
    """E-17: whether an id is a batch label."""
    return F.coalesce(F.lower(c).startswith("batch:"), F.lit(False))


def lm_text(c: Column, spaced: bool = True) -> Column:
    """E-20: rare letters masked as X, letters joined by blanks when ``spaced``."""
    masked = F.regexp_replace(c, "[UZOB]", "X")
    return F.rtrim(F.regexp_replace(masked, "(.)", "$1 ")) if spaced else masked


def encode_sequence(c: Column, max_len: int) -> Column:
    """E-21: letters as 1..20, others 0, cut and padded to ``max_len``."""
    letters = F.filter(F.split(F.substring(c, 1, max_len), ""), lambda x: x != "")
    codes = F.transform(letters, lambda x: F.instr(F.lit(STANDARD_LETTERS), x))
    padding = F.array_repeat(F.lit(0), F.greatest(F.lit(0), F.lit(max_len) - F.size(codes)))
    return F.concat(codes, padding)


def kmer_list(c: Column, k: int = 3) -> Column:
    """E-22: overlapping k-mers in order; one pass over the text."""
    return F.regexp_extract_all(c, F.lit(f"(?=(.{{{k}}}))"), F.lit(1))


def letter_count(c: Column, letters: str) -> Column:
    """How many characters of ``c`` are among ``letters``."""
    return F.length(c) - F.length(F.regexp_replace(c, f"[{letters}]", ""))


def _share(count: Column, c: Column) -> Column:
    return F.try_divide(count.cast("double"), F.length(c).cast("double"))


def aa_composition(c: Column) -> Column:
    """E-23: share of each standard letter, as a map."""
    pairs = []
    for letter in STANDARD_LETTERS:
        n = F.length(c) - F.length(F.replace(c, F.lit(letter), F.lit("")))
        pairs += [F.lit(letter), _share(n, c)]
    return F.create_map(*pairs)


def physchem(c: Column) -> Column:
    """E-24: hydrophobic, polar and charged shares, mass and length, as a struct."""
    return F.struct(
        _share(letter_count(c, HYDROPHOBIC), c).alias("hydrophobic_ratio"),
        _share(letter_count(c, POLAR), c).alias("polar_ratio"),
        _share(letter_count(c, CHARGED), c).alias("charged_ratio"),
        (F.length(c) * RESIDUE_MASS).cast("bigint").alias("molecular_weight"),
        F.length(c).cast("bigint").alias("length"),
    )


def preview(c: Column, n: int = 60) -> Column:
    """E-25: length and leading characters, as a struct."""
    return F.struct(
        F.length(c).cast("bigint").alias("length"), F.substring(c, 1, n).alias("sequence_preview")
    )


def clip_score(c: Column) -> Column:
    """E-31: score limited to [0, 1]; null stays null."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(0.0)), F.lit(1.0)))


def retryable(error_code: Column, stage_name: Column) -> Column:
    """ST-16: may a failed event be sent again?"""
    return (
        F.when(stage_name == "spark_validation", False)
        .when(error_code == "INVALID_SEQUENCE", False)
        .otherwise(True)
    )
