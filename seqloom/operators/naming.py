"""Unique identifiers for repeated names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqloom.operators.lineage import cut_lineage
from seqloom.operators.ordering import number_rows, running_totals


def _suffixed(base, rank):
    return F.when(rank == 1, base).otherwise(F.concat_ws("_", base, rank.cast("string")))


def _effective(blockers: DataFrame) -> DataFrame:
    """Numbers (_base, _k) that rows skip, of blockers (_base, _k, _c).

    Blocker k is skipped if fewer than c of the lower ones are. The count so far lies between the
    sure ones and all that may still be; each round settles every blocker that both ends agree on,
    the lowest open one of each base at least.
    """
    state = blockers.withColumn("_skipped", F.lit(None).cast("boolean"))
    while True:
        sure, maybe = F.coalesce(F.col("_skipped"), F.lit(False)), F.col("_skipped").isNull()
        counted = running_totals(
            state, ["_k"], {"_sure": sure.cast("bigint"), "_maybe": maybe.cast("bigint")}, ["_base"]
        )
        low = F.col("_sure") - sure.cast("bigint")
        high = low + F.col("_maybe") - maybe.cast("bigint")
        decided = F.when(~maybe, F.col("_skipped")).when(F.col("_c") > high, True).when(F.col("_c") <= low, False)
        state = cut_lineage(counted.select("_base", "_k", "_c", decided.alias("_skipped")))
        if state.filter(F.col("_skipped").isNull()).isEmpty():
            return state.filter("_skipped").select("_base", "_k")


def _number(wants: DataFrame, blockers: DataFrame) -> DataFrame:
    """Numbers from 2 for rows (_pos, _base, _j), the _j-th of their base that need one.

    A blocker (_base, _k, _q) is the number k of an id that stands at position q: it is skipped by
    rows that reach it after q, and free for those before. Numbers of a base grow with position, so
    the rows fill, by rank, the gaps between the skipped numbers.
    """
    none = F.lit(None).cast("bigint")
    both = wants.select("_base", "_pos", none.alias("_k")).unionByName(
        blockers.select("_base", F.col("_q").alias("_pos"), "_k")
    )
    before = running_totals(both, ["_pos"], {"_r": F.col("_k").isNull().cast("bigint")}, ["_base"])
    reach = before.filter(F.col("_k").isNotNull()).select("_base", "_k", (F.col("_k") - 1 - F.col("_r")).alias("_c"))
    skipped = number_rows(_effective(reach), ["_k"], ["_base"], "_e")
    # so many free numbers lie below the e-th skipped one
    gaps = skipped.select("_base", (F.col("_k") - F.col("_e")).alias("_at"), none.alias("_pos"), "_k")
    rows = wants.select("_base", F.col("_j").alias("_at"), "_pos", none.alias("_k"))
    filled = running_totals(
        rows.unionByName(gaps), ["_at", F.col("_k").isNull(), "_k"], {"_n": F.col("_k").isNotNull().cast("bigint")}, ["_base"]
    )
    return filled.filter(F.col("_k").isNull()).select("_pos", "_base", (F.col("_at") + 1 + F.col("_n")).alias("_number"))


def _settle(rows: DataFrame) -> DataFrame:
    """First-come names of rows (_pos, _base, _rn) in families whose ids clash.

    Only rows of base ``b`` and the first row with the id ``b_k`` itself ever ask for the name
    ``b_k``. So the names of a base follow from its own rows, the first places of the ids ``b_k``
    and whether its own name was gone when it came; bases are named in rounds, one for each
    level of suffixes.
    """
    parts = [F.regexp_extract("_base", r"^(.+)_([1-9][0-9]{0,17})$", g) for g in (1, 2)]
    firsts = rows.filter("_rn = 1").select(
        "_base", F.col("_pos").alias("_q"), parts[0].alias("_parent"), F.nullif(parts[1], F.lit("")).cast("bigint").alias("_k")
    )
    parents = firsts.select(F.col("_base").alias("_parent"), F.lit(True).alias("_known"))
    firsts = cut_lineage(firsts.join(parents, "_parent", "left"))
    child = F.col("_known").isNotNull() & (F.col("_k") >= 2)
    children = firsts.filter(child).select("_base", "_q", "_parent", "_k")
    level = cut_lineage(firsts.filter(~F.coalesce(child, F.lit(False))).select("_base", F.lit(False).alias("_lost")))
    names = None
    while not level.isEmpty():
        own = rows.join(level, "_base")
        wants = own.withColumn("_j", F.col("_rn") - F.when(F.col("_lost"), 0).otherwise(1)).filter("_j > 0")
        wants = cut_lineage(wants.select("_pos", "_base", "_j"))
        near = children.join(level.select(F.col("_base").alias("_parent")), "_parent")
        blockers = near.select(F.col("_parent").alias("_base"), "_k", "_q")
        numbered = cut_lineage(_number(wants, blockers))
        held = own.filter(~F.col("_lost") & (F.col("_rn") == 1)).select("_pos", F.col("_base").alias("_name"))
        named = held.unionByName(numbered.select("_pos", _suffixed(F.col("_base"), F.col("_number")).alias("_name")))
        names = named if names is None else names.unionByName(named)
        taken = numbered.select(F.col("_base").alias("_parent"), F.col("_number").alias("_k"), F.lit(True).alias("_gone"))
        lost = F.coalesce(F.col("_gone"), F.lit(False)).alias("_lost")
        level = cut_lineage(near.join(taken, ["_parent", "_k"], "left").select("_base", lost))
    return rows.select("_pos", F.col("_base").alias("_name")) if names is None else names


def unique_ids(df: DataFrame, position: str, key: str = "protein_id") -> DataFrame:
    """E-18: repeated ids become ``id_2``, ``id_3``, ... (first free number), in ``position`` order;
    a missing id becomes ``protein_n`` with n = position + 1 (positions start at 0).

    The number is just the rank among equal ids unless another id already looks like a suffixed
    one. Such families (ids that agree without their numeric tails) are named first-come: the free
    numbers of an id are the gaps between the taken ones, matched to its rows by rank.
    """
    base = F.coalesce(
        F.nullif(F.col(key), F.lit("")), F.concat(F.lit("protein_"), (F.col(position) + 1).cast("string"))
    )
    rows = df.select(F.col(position).alias("_pos"), base.alias("_base"))
    ranked = cut_lineage(number_rows(rows, ["_pos"], ["_base"], "_rn"))
    family = F.regexp_replace("_base", r"(_\d+)+$", "")
    families = ranked.groupBy(family.alias("_family")).agg(
        F.max("_rn").alias("_most"), (F.min("_base") != F.max("_base")).alias("_mixed")
    )
    tangled = families.filter(F.col("_mixed") & (F.col("_most") > 1)).select("_family", F.lit(True).alias("_tangled"))
    placed = ranked.withColumn("_family", family).join(tangled, "_family", "left")
    plain = placed.filter(F.col("_tangled").isNull())
    names = plain.select("_pos", _suffixed(F.col("_base"), F.col("_rn")).alias("_name"))
    names = names.unionByName(_settle(placed.filter("_tangled").select("_pos", "_base", "_rn")))
    joined = df.join(names, df[position] == names["_pos"])
    return joined.select(*[F.col("_name").alias(c) if c == key else df[c] for c in df.columns])
