"""Hard negatives of anchors by slots of the score axis.

Each positive of an anchor asks for the best rows of other labels whose score lies between a lower and an
upper share of its own. These ranges overlap. The upper limits of the positives cut the axis into
disjoint slots; the best ``k`` rows of each slot, and nothing else, answer every range: what lies below
an upper limit is the slots from there down, whose lists follow one another in order, so the list of a
range is the merged suffix of the slots, cut at ``k``, less what lies under its lower limit.

Two passes hold all anchors against all rows, in blocks. Rows are dealt to slices and anchors to groups,
both by number; a task gets one slice and one group, works in pieces of bounded size and hands on the
best few per anchor (first pass: positives) or per anchor and slot (second pass). Labels play no part in
the dealing, so a label that most rows share changes nothing. The number of slices follows the rows, so
the lists to be merged stay small against the rows they come from.

Scores are whole numbers, computed in floating point where that is exact, in 64-bit integers beyond, and
held at the ends of the long range beyond that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, ready_for_python

POSITIVES = 5
NEGATIVES = 10
#: A negative's score is from 30 to 90 hundredths of the positive's.
LEAST, MOST = 30, 90
ANCHOR_EVERY = 100
#: Bounds of what one task holds of rows and anchors, and of what it scores together.
SLICE_BYTES = 64 << 20
GROUP_BYTES = 64 << 20
PIECE_ANCHORS = 256
PIECE_ROWS = 8192
LONGEST = np.iinfo(np.int64).max


def rows_of(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows that take part. Those with a null label or vector or a component
    that is null or not finite do not; labels move on by one, modulo ten, where 7 divides the id;
    components are floor(256 x). Rows may repeat ids; each counts for itself."""
    whole = F.expr("forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    scaled = F.expr("transform(embedding, x -> floor(256 * double(x)))")
    return embeddings.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), F.transform(scaled, lambda x: x.cast("double")).alias("vector")
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of a matrix; what is missing up to ``width`` is zero, what lies beyond is left."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    made = np.zeros((len(sizes), width))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    for k, n in enumerate(np.minimum(sizes, width)):
        made[k, :n] = flat[starts[k] : starts[k] + n]
    return made


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    largest = float(np.abs(anchors).max()) * float(np.abs(rows).max()) * anchors.shape[1]
    if largest < 2**53:
        return (anchors @ rows.T).astype(np.int64)
    if largest < 2**63:
        return anchors.astype(np.int64) @ rows.astype(np.int64).T
    exact = [[int(x) for x in r] for r in anchors.tolist()], [[int(x) for x in r] for r in rows.tolist()]
    found = [[sum(x * y for x, y in zip(a, b, strict=True)) for b in exact[1]] for a in exact[0]]
    return np.array([[max(min(x, LONGEST), -LONGEST) for x in r] for r in found], np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(anchor, row) of the ``k`` allowed rows of largest score per anchor; rows stand in tie order."""
    n = scores.shape[1]
    if np.abs(scores, where=allowed, out=np.zeros_like(scores)).max(initial=0) < 2**61 // max(n, 1):
        # one number for score and place: distinct, so the k largest are settled without sorting all
        keys = np.where(allowed, scores * n + np.arange(n - 1, -1, -1), -LONGEST)
        at = np.argpartition(-keys, min(k, n) - 1, axis=1)[:, :k] if n > k else np.broadcast_to(np.arange(n), scores.shape)
    else:
        at = np.argsort(np.where(allowed, -scores, LONGEST), axis=1, kind="stable")
        kept = np.take_along_axis(allowed, at, 1)
        at = np.take_along_axis(at, np.argsort(~kept, axis=1, kind="stable"), 1)[:, :k]
    anchor = np.repeat(np.arange(len(scores)), at.shape[1])
    at = at.ravel()
    kept = allowed[anchor, at]
    return anchor[kept], at[kept]


def positives_of(asked: pa.Table, piece: pa.Table, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First pass: other rows of the anchor's label."""
    same = asked["label"].to_numpy()[:, None] == piece["label"].to_numpy()
    itself = asked["uid"].to_numpy()[:, None] == piece["uid"].to_numpy()
    yield 0, *best(scores, same & ~itself, POSITIVES)


def negatives_of(asked: pa.Table, piece: pa.Table, scores: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Second pass: rows of other labels, slot by slot from the highest limit down."""
    other = asked["label"].to_numpy()[:, None] != piece["label"].to_numpy()
    limits = np.full((len(scores), POSITIVES + 1), -LONGEST)
    for row, own in enumerate(asked["limits"].to_pylist()):
        limits[row, : len(own)] = own
    least = asked["least"].to_numpy()[:, None]
    for slot in range(POSITIVES):
        upper, lower = limits[:, slot, None], limits[:, slot + 1, None]
        inside = other & (scores <= upper) & (scores > lower) & (scores >= least)
        if inside.any():
            yield slot, *best(scores, inside, NEGATIVES)


#: What a pass hands on: number of the anchor, slot, and score, id and number of the row.
FOUND = pa.schema([("uid", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("other_id", pa.int64()), ("other", pa.int64())])


def tie_order(table: pa.Table, *first: np.ndarray) -> np.ndarray:
    """Places in the order of ``first``, then smaller ids, null ids last."""
    name = "other_id" if "other_id" in table.column_names else "vec_id"
    ids = table[name].fill_null(0).to_numpy()
    return np.lexsort((ids, table[name].is_null().to_numpy(), *reversed(first)))


def held_against(asked: pa.Table, block: pa.Table, of_piece, k: int) -> pa.Table:
    """All anchors of a group against all rows of a slice: the best ``k`` per anchor and slot."""
    block = block.take(pa.array(tie_order(block)))
    kept = [FOUND.empty_table()]
    for a in range(0, asked.num_rows, PIECE_ANCHORS):
        some = asked.slice(a, PIECE_ANCHORS)
        width = int(some["vector"].combine_chunks().value_lengths().to_numpy().max())
        vectors, found = matrix(some["vector"], width), []
        for r in range(0, block.num_rows, PIECE_ROWS):
            piece = block.slice(r, PIECE_ROWS)
            scores = products(vectors, matrix(piece["vector"], width))
            for slot, anchor, row in of_piece(some, piece, scores):
                at = pa.array(row)
                columns = [some["uid"].take(pa.array(anchor)), pa.array(np.full(len(row), slot, np.int32)), pa.array(scores[anchor, row]), piece["vec_id"].take(at), piece["uid"].take(at)]
                found.append(pa.table(columns, schema=FOUND))
        merged = pa.concat_tables([FOUND.empty_table(), *found])
        uid, slot, score = (merged[c].to_numpy() for c in ("uid", "slot", "score"))
        order = tie_order(merged, uid, slot, -score)
        group = np.stack([uid, slot.astype(np.int64)])[:, order]
        opens = np.flatnonzero(np.concatenate(([True], (group[:, 1:] != group[:, :-1]).any(0)))) if len(order) else np.zeros(0, np.int64)
        rank = np.arange(len(order)) - np.repeat(opens, np.diff(np.append(opens, len(order))))
        kept.append(merged.take(pa.array(order[rank < k])))
    return pa.concat_tables(kept)


def in_blocks(rows: DataFrame, anchors: DataFrame, slices: int, groups: int, of_piece, k: int) -> DataFrame:
    """Every anchor against every row, a slice of rows and a group of anchors per task."""
    dealt = lambda n, salt: F.pmod(F.xxhash64(F.lit(salt), F.col("uid")), F.lit(n)).cast("int")
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("_slice", dealt(slices, 1)).withColumn("_group", spread(groups))
    right = anchors.withColumn("_group", dealt(groups, 2)).withColumn("_slice", spread(slices))

    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        return held_against(asked, block, of_piece, k)

    result = "uid bigint, slot int, score bigint, other_id bigint, other bigint"
    return left.groupBy("_group", "_slice").cogroup(right.groupBy("_group", "_slice")).applyInArrow(run, result)


def share(score: str, hundredths: int, up: bool) -> str:
    """SQL of a share of a score that is not negative, rounded up or down, without overflow."""
    rest = f"pmod({score}, 100) * {hundredths}"
    return f"({score} div 100) * {hundredths} + ({rest} + {99 if up else 0}) div 100"


def first_per(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The best ``k`` rows per key; Spark prunes on every task before the shuffle."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and
    each of its positives the best rows of other labels within the range of the positive's score.

    Anchors are rows whose id is divisible by ``ANCHOR_EVERY``; positives the best ``POSITIVES`` other
    rows of the label, equal rows included. Higher scores come first, ties go to smaller ids, null ids
    last. Vectors of different lengths meet as if the shorter one went on with zeros. An anchor without
    positives or negatives has no rows; an empty table gives none.
    """
    spark = embeddings.sparkSession
    ready_for_python(spark)
    scratch = Scratch(spark)
    # written once: numbers of rows must not change when a task is run again
    rows = scratch.cut(rows_of(embeddings).withColumn("uid", F.monotonically_increasing_id()))
    anchors = rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0)
    bytes_of = F.coalesce(F.sum(8 * F.size("vector") + 32), F.lit(0))
    is_anchor = F.coalesce(F.col("vec_id") % ANCHOR_EVERY == 0, F.lit(False))
    all_bytes, asked_bytes = rows.agg(bytes_of, F.coalesce(F.sum(F.when(is_anchor, 8 * F.size("vector") + 32)), F.lit(0))).first()
    slices = max(-(-all_bytes // SLICE_BYTES), 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(-(-asked_bytes // GROUP_BYTES), 1)

    met = in_blocks(rows, anchors, slices, groups, positives_of, POSITIVES)
    positive = scratch.cut(first_per(met, ["uid"], POSITIVES).filter("score >= 0"))  # no score lies in the range of a negative one
    ranges = positive.select("uid", F.col("other_id").alias("positive_id"), F.col("score").alias("positive_score"), "rank").withColumns(
        {"upper": F.expr(share("positive_score", MOST, False)), "lower": F.expr(share("positive_score", LEAST, True))}
    )
    cuts = ranges.groupBy("uid").agg(F.sort_array(F.collect_set("upper"), asc=False).alias("limits"), F.min("lower").alias("least"))

    asked = scratch.cut(anchors.join(cuts, "uid"))
    slots = first_per(in_blocks(rows, asked, slices, groups, negatives_of, NEGATIVES), ["uid", "slot"], NEGATIVES)
    # at most POSITIVES x NEGATIVES of an anchor; in order of slots this is one list in order of scores
    entry = F.struct("slot", F.col("rank").alias("place"), F.col("other_id").alias("negative_id"), F.col("score").alias("negative_score"))
    lists = slots.groupBy("uid").agg(F.sort_array(F.collect_list(entry)).alias("merged"))
    suffix = F.expr(f"slice(filter(merged, x -> x.slot >= array_position(limits, upper) - 1), 1, {NEGATIVES})")
    inside = F.filter(suffix, lambda x: x["negative_score"] >= F.col("lower"))
    wanted = ranges.drop("rank").join(asked.select("uid", F.col("vec_id").alias("anchor_id"), "limits"), "uid").join(lists, "uid")
    listed = wanted.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("_at", "_found"))
    return listed.select(
        "anchor_id", "positive_id", (F.col("_at") + 1).alias("rank"), "_found.negative_id", "positive_score", "_found.negative_score"
    )
