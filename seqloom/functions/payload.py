"""Expressions on prediction payloads kept as JSON text, and column-name resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.functions.scalars import map_aspect

# Alias order of payload keys.
SCORE_KEYS = ("score", "confidence", "probability", "prob", "p", "value")
TERM_KEYS = ("term_id", "go_term", "go_id", "id")

PAYLOAD_SCHEMA = (
    "top_terms ARRAY<STRING>, predictions ARRAY<STRING>, score_map MAP<STRING,DOUBLE>, "
    "top_scores ARRAY<DOUBLE>, predicted_terms ARRAY<STRING>"
)
ROW_SCHEMA = "model STRING, protein_id STRING, go_term STRING, score DOUBLE, aspect STRING, name STRING"


def _field(obj: Column, key: str) -> Column:
    return F.get_json_object(obj, f"$.{key}")


def score_of(obj: Column, default: Column | None = None) -> Column:
    """E-14: first score alias of a JSON object that reads as a number."""
    options = [_field(obj, k).try_cast("double") for k in SCORE_KEYS]
    return F.coalesce(*options, F.lit(0.0) if default is None else default)


def term_of(obj: Column) -> Column:
    """E-14: first non-empty term alias of a JSON object, trimmed; empty when there is none."""
    options = [F.nullif(_field(obj, k), F.lit("")) for k in TERM_KEYS]
    return F.trim(F.coalesce(*options, F.lit("")))


def is_json_object(c: Column) -> Column:
    return F.coalesce(F.ltrim(F.get_json_object(c, "$")).startswith("{"), F.lit(False))


def decode_row(row: Column, schema: str = ROW_SCHEMA) -> Column:
    """E-27 for a table with one JSON text a row: its struct, null where it is not a JSON object."""
    return F.when(is_json_object(row), F.from_json(row, schema))


def decode_rows(rows: Column, schema: str = ROW_SCHEMA) -> Column:
    """E-27: list of JSON texts to structs; items that are not JSON objects are skipped."""
    return F.transform(F.filter(rows, is_json_object), lambda x: F.from_json(x, schema))


def score_map(rows: Column) -> Column:
    """E-29: term to score; a repeated term keeps its first place and last score."""
    return F.map_from_entries(F.transform(rows, lambda r: F.struct(r["go_term"], r["score"])))


def score_rows(df: DataFrame, keys: Sequence[str], term: str, score: str, order: Sequence[str]) -> DataFrame:
    """E-29 for a table of (keys, term, score) rows: one row per term, with the order columns of its
    first row as ``first_place`` and the score of its last.
    """
    place = F.struct(*order)
    return df.groupBy(*keys, term).agg(F.min(place).alias("first_place"), F.max_by(score, place).alias(score))


ITEM_SCHEMA = ", ".join(
    f"{k} STRING" for k in (*TERM_KEYS, *SCORE_KEYS, "term_name", "name", "ontology", "aspect", "definition")
)


def _filled(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _scored_terms(p: Column) -> Column:
    """Sorted term structs of one parsed payload."""
    scores = F.coalesce(p["score_map"], F.create_map().cast("map<string,double>"))
    ranked = F.coalesce(p["top_scores"], F.array().cast("array<double>"))
    empty = F.array().cast("array<string>")

    def parse(item: Column, place: Column) -> Column:
        named = item.startswith("{")
        fields = F.when(named, F.from_json(item, ITEM_SCHEMA))
        return F.struct(fields.alias("f"), F.when(~named, item).alias("bare"), place.alias("place"))

    def term(x: Column) -> Column:
        f = x["f"]
        name = F.trim(F.coalesce(*[_filled(f[k]) for k in TERM_KEYS], F.lit("")))
        term_id = F.coalesce(x["bare"], name)
        return F.struct(
            term_id.alias("term_id"),
            F.coalesce(
                *[f[k].try_cast("double") for k in SCORE_KEYS],
                F.try_element_at(scores, term_id),
                F.get(ranked, x["place"]),
                F.lit(0.0),
            ).alias("score"),
            x["place"].alias("place"),
            F.coalesce(f["term_name"], f["name"]).alias("term_name"),
            map_aspect(F.coalesce(_filled(f["ontology"]), f["aspect"])).alias("ontology"),
            f["definition"].alias("definition"),
        )

    def listed(items: Column) -> Column:
        # parsed in a pass of its own, so every item is parsed once
        return F.filter(F.transform(F.transform(items, parse), term), lambda t: t["term_id"] != "")

    main = listed(F.coalesce(p["top_terms"], p["predictions"], empty))
    spare = listed(F.coalesce(p["predicted_terms"], empty))
    # a one-element list names the parsed items, so they are parsed once and not for their number too
    chosen = F.get(F.transform(F.array(main), lambda m: F.when(F.size(m) > 0, m).otherwise(spare)), F.lit(0))
    keyed = F.transform(chosen, lambda t: F.struct((-t["score"]).alias("k"), t["place"], t.alias("t")))
    return F.transform(
        F.array_sort(keyed),
        lambda x: F.struct(
            *[x["t"][c].alias(c) for c in ("term_id", "term_name", "ontology", "score", "definition")]
        ),
    )


def terms_of(payload: Column) -> Column:
    """E-28: scored terms of a payload, best score first, payload order on ties.

    Items may be objects or bare ids. A score comes from the object, else the score map, else the
    positional list. ``predicted_terms`` is used when the main list gives nothing.
    """
    parsed = F.from_json(payload, PAYLOAD_SCHEMA)
    # a one-element list names the parsed payload, so it is parsed once
    return F.get(F.transform(F.array(parsed), _scored_terms), F.lit(0))


def dedupe_names(columns: Sequence[str]) -> list[str]:
    """E-30: names without outer blanks; the n-th repetition of a name ends in ``__dup`` and n."""
    names = [str(c).strip() for c in columns]
    earlier = [names[:i].count(name) for i, name in enumerate(names)]
    return [name + f"__dup{n}" * (n > 0) for name, n in zip(names, earlier, strict=True)]


def resolve_column(columns: Sequence[str], names: Sequence[str], tokens: Sequence[str] = ()) -> str | None:
    """E-30: the best ranked column: by the first of ``names`` it equals, then by holding all ``tokens``,
    ignoring case. Of columns that equal the same name the last counts, of others the first.
    """
    ranks = {name.lower(): i for i, name in reversed(list(enumerate(names)))}

    def rank(place: int) -> tuple[int, int]:
        low = columns[place].lower()
        if low in ranks:
            return ranks[low], -place
        return len(names) + (not tokens or any(t.lower() not in low for t in tokens)), place

    best = min(range(len(columns)), key=rank, default=None)
    return None if best is None or rank(best)[0] > len(names) else columns[best]


# Evaluator column -> (candidate names, tokens all contained).
EVAL_COLUMNS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "method": (("filename", "file", "method", "model", "pred_file"), ("file",)),
    "namespace": (("namespace", "ontology", "aspect", "ns"), ("namespace",)),
    "threshold": (("threshold", "th", "tau", "cutoff"), ("th",)),
    "f": (("f", "fmax", "f_max"), ()),
    "f_w": (("f_w", "wf", "weighted_f", "weighted_fmax", "f_weighted"), ("f", "w")),
    "f_micro": (("f_micro", "micro_f", "micro_f1"), ("f", "micro")),
    "f_micro_w": (("f_micro_w", "micro_f_w", "weighted_micro_f"), ("f", "micro", "w")),
    "precision": (("precision", "pr", "p"), ("precision",)),
    "recall": (("recall", "rc", "r"), ("recall",)),
    "s": (("s", "smin", "s_min"), ()),
}


def resolve_columns(
    df: DataFrame, spec: Mapping[str, tuple[Sequence[str], Sequence[str]]] = EVAL_COLUMNS
) -> DataFrame:
    """E-30: one column per entry of ``spec``; an entry nothing matches is null.

    Text entries (method, namespace) stay text, the rest become numbers.
    """
    out = []
    for target, (names, tokens) in spec.items():
        found = resolve_column(df.columns, names, tokens)
        kind = "string" if target in ("method", "namespace") else "double"
        source = F.lit(None) if found is None else F.col(f"`{found}`")
        out.append(source.try_cast(kind).alias(target))
    kept = [c for c in df.columns if c.startswith("_")]
    return df.select(*kept, *out)
