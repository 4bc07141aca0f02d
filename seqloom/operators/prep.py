"""Label universe, strata, splits, label pairs and training weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.operators.agg import median_of
from seqloom.operators.graph import degrees
from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import number_rows


# Fixed values of label selection, strata and weights.
MIN_LABEL_FREQUENCY = 8
MAX_LABELS = 3000
FEW, MID = 3, 10
RARE_STRATUM = 5
POS_WEIGHT_CLIP = 30.0
IA_WEIGHT_CLIP = 8.0
IA_POWER = 0.5


def select_terms(ann: DataFrame, min_frequency: int = MIN_LABEL_FREQUENCY, max_labels: int = MAX_LABELS) -> DataFrame:
    """M-01: frequent terms with their index (frequency descending, then term).

    The limit keeps ``max_labels`` rows, so numbering them in one window is bounded.
    """
    counts = ann.groupBy("term").agg(F.count("*").alias("frequency")).filter(F.col("frequency") >= min_frequency)
    top = counts.orderBy(F.desc("frequency"), F.asc("term")).limit(max_labels)
    place = F.row_number().over(Window.orderBy(F.desc("frequency"), F.asc("term")))
    return top.select("term", "frequency", (place - 1).cast("bigint").alias("term_index"))


def usable(ann: DataFrame, selected: DataFrame, sequences: DataFrame | None = None) -> DataFrame:
    """M-02: annotated proteins (with a sequence, if given) that carry a selected term."""
    rows = ann.join(selected.select("term"), "term", "left_semi")
    if sequences is not None:
        rows = rows.join(sequences.select("protein_id"), "protein_id", "left_semi")
    return rows.select("protein_id").distinct()


def strata(ann: DataFrame) -> DataFrame:
    """M-03: aspect signature and annotation-count band per protein; small strata become ``rare``.

    Strata are few and large, so their sizes are counted and joined back, not windowed.
    """
    pairs = ann.select("protein_id", "term", "aspect").groupBy("protein_id", "term").agg(
        *[F.max((F.col("aspect") == a).cast("int")).alias(a) for a in ("MF", "BP", "CC")]
    )
    n = F.col("n_terms")
    has = lambda a: F.when(F.col(a) == 1, F.lit(a)).otherwise(F.lit(""))
    signature = F.nullif(F.concat(has("MF"), has("BP"), has("CC")), F.lit(""))
    band = F.when(n <= FEW, "few").when(n <= MID, "mid").otherwise("many")
    labelled = (
        pairs.groupBy("protein_id")
        .agg(F.count("*").alias("n_terms"), *[F.max(a).alias(a) for a in ("MF", "BP", "CC")])
        .select("protein_id", F.concat_ws("_", F.coalesce(signature, F.lit("UNK")), band).alias("_stratum"))
    )
    sizes = labelled.groupBy("_stratum").agg(F.count("*").alias("_size"))
    return labelled.join(sizes, "_stratum").select(
        "protein_id",
        F.when(F.col("_size") >= RARE_STRATUM, F.col("_stratum")).otherwise("rare").alias("stratum"),
    )


def split(df: DataFrame, valid: float = 0.15, test: float = 0.15, seed: int = 42) -> DataFrame:
    """M-04: train / valid / test per stratum, by a seeded hash order, at rounded quotas.

    The same ids and seed always give the same split. Strata larger than one task can order are
    numbered across tasks.
    """
    mixed = df.withColumn("_hash", F.md5(F.concat(F.lit(f"{seed}:"), F.col("protein_id").cast("string"))))
    numbered = number_rows(mixed, ["_hash", "protein_id"], ["stratum"], "_place")
    sizes = df.groupBy("stratum").agg(F.count("*").alias("_size"))
    n_test, n_valid = F.bround(F.col("_size") * F.lit(test)), F.bround(F.col("_size") * F.lit(valid))
    name = (
        F.when(F.col("_place") <= n_test, "test")
        .when(F.col("_place") <= n_test + n_valid, "valid")
        .otherwise("train")
    )
    return numbered.join(sizes, "stratum").select("protein_id", "stratum", name.alias("split"))


def labels(ann: DataFrame, terms: DataFrame) -> DataFrame:
    """M-05: sparse label pairs (protein, term index)."""
    pairs = ann.select("protein_id", "term").distinct()
    return pairs.join(terms.select("term", "term_index"), "term").select("protein_id", "term_index")


def verify_split(left: DataFrame, right: DataFrame) -> DataFrame:
    """M-18: (id, split) rows found on one side only; empty when the splits agree."""
    a, b = left.select("protein_id", "split"), right.select("protein_id", "split")
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(
        b.exceptAll(a).withColumn("side", F.lit("right"))
    )


def ground_truth(ann: DataFrame, ids: DataFrame, terms: DataFrame) -> DataFrame:
    """M-16: distinct (protein, term) of the listed proteins and terms of interest."""
    from seqloom.operators.joins import restrict

    return restrict(ann, ids, terms).select("protein_id", "term").distinct()


def pos_weight(positives: Column, n: Column, clip: float = POS_WEIGHT_CLIP) -> Column:
    """A-35: square root of negatives per positive, limited to [1, clip]."""
    ratio = (n - positives) / F.greatest(positives, F.lit(1.0))
    return F.least(F.greatest(F.sqrt(ratio), F.lit(1.0)), F.lit(clip))


def ia_weight(terms: DataFrame, power: float = IA_POWER, clip: float = IA_WEIGHT_CLIP) -> DataFrame:
    """A-36: loss weight per term from its accretion, relative to the mean over the terms."""
    usable_ia = F.col("ia").isNotNull() & ~F.isnan("ia") & (F.abs("ia") != float("inf"))
    value = F.when(usable_ia, F.col("ia")).otherwise(F.lit(1.0))
    raised = terms.withColumn("_p", F.pow(F.greatest(value, F.lit(1e-6)), F.lit(power)))
    mean = raised.agg(F.greatest(F.avg("_p"), F.lit(1e-6))).scalar()
    weight = F.least(F.greatest(F.col("_p") / mean, F.lit(0.25)), F.lit(clip))
    return raised.select(*terms.columns, weight.alias("ia_loss_weight"))


def term_weights(terms: DataFrame, label_pairs: DataFrame, proteins: DataFrame, ia: DataFrame, edges: DataFrame,
                 ontology: DataFrame) -> DataFrame:
    """A-37: per-term training table: name, aspect, positives, weights, degrees."""
    n = proteins.select("protein_id").distinct().agg(F.count("*")).scalar()
    positives = label_pairs.groupBy("term_index").agg(F.count("*").alias("positives"))
    base = (
        terms.join(positives, "term_index", "left")
        .withColumn("positives", F.coalesce("positives", F.lit(0)))
        .join(ia.select("term", "ia"), "term", "left")
        .withColumn("ia", F.coalesce("ia", F.lit(1.0)))
    )
    weighted = ia_weight(base).withColumn("pos_weight", pos_weight(F.col("positives"), n))
    return (
        weighted.join(degrees(edges, terms), "term")
        .join(ontology.select("term", "name", "aspect"), "term", "left")
        .select(
            "term", "term_index",
            F.coalesce("name", F.lit("")).alias("name"),
            F.coalesce("aspect", F.lit("UNK")).alias("aspect"),
            "positives", "pos_weight", "ia", "ia_loss_weight", "n_parents", "n_children",
        )
    )


def split_summary(splits: DataFrame, ann: DataFrame, selected: DataFrame) -> DataFrame:
    """A-14: sizes, ratios, mean and median term counts and proteins per aspect for every split."""
    marked = ann.join(selected.select("term", F.lit(1).alias("_sel")), "term", "left")
    per_pair = marked.groupBy("protein_id", "term").agg(
        F.max("_sel").alias("_sel"), *[F.max((F.col("aspect") == a).cast("int")).alias(a) for a in ("MF", "BP", "CC")]
    )
    per_protein = per_pair.groupBy("protein_id").agg(
        F.count("*").alias("n_full"),
        F.count("_sel").alias("n_selected"),
        *[F.max(a).alias(a) for a in ("MF", "BP", "CC")],
    )
    joined = cut_lineage(
        splits.select("protein_id", "split").join(per_protein, "protein_id", "left")
        .fillna(0, ["n_full", "n_selected", "MF", "BP", "CC"])
    )
    total = joined.agg(F.count("*")).scalar()
    sums = joined.groupBy("split").agg(
        F.count("*").alias("proteins"),
        (F.count("*").cast("double") / total.cast("double")).alias("protein_ratio"),
        F.avg("n_full").alias("avg_full_terms"),
        F.avg("n_selected").alias("avg_selected_terms"),
        *[F.sum(a).cast("bigint").alias(f"proteins_with_{a}") for a in ("MF", "BP", "CC")],
    )
    medians = median_of(joined, "n_selected", ["split"]).withColumnRenamed("median", "median_selected_terms")
    return sums.join(medians, "split")


def label_density(label_pairs: DataFrame, splits: DataFrame, terms: DataFrame) -> DataFrame:
    """A-15: positives, share of positive cells, and share of terms seen, per split."""
    n_terms = terms.agg(F.count("*")).scalar()
    sizes = splits.groupBy("split").agg(F.count("*").alias("n_proteins"))
    tagged = label_pairs.join(splits.select("protein_id", "split"), "protein_id")
    per_term = tagged.groupBy("split", "term_index").agg(F.count("*").alias("_n"))
    found = per_term.groupBy("split").agg(F.sum("_n").alias("positive_labels"), F.count("*").alias("_terms"))
    cells = (F.col("n_proteins") * n_terms).cast("double")
    positives = F.coalesce("positive_labels", F.lit(0))
    return sizes.join(found, "split", "left").select(
        "split",
        positives.alias("positive_labels"),
        (positives / cells).alias("density"),
        (F.coalesce("_terms", F.lit(0)) / n_terms.cast("double")).alias("term_coverage"),
    )

