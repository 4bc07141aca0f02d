"""Near-duplicate groups by MinHash bands, odd sketches and exact confirmation.

1. Every whole text becomes its set of 5-word shingles; a Python task hashes a batch of texts at a
   time and returns 128 MinHash samples folded two ways: 32 band keys of 4 samples, and an odd
   sketch, a bitmap of 256 parities whose exclusive-or counts the samples in which two sets differ.
2. Rows of equal sets are one class, kept by its smallest id; everything below sees classes.
3. In rounds, each band bucket compares its members with one pivot. Odd sketches pick, for each
   member, the pivot most like it; those pairs are confirmed on the full sets, and linked classes
   are joined. Later rounds look only at buckets that hold several groups.
4. Of the other pairs that share a bucket only those in different groups can still matter, and of
   those only the ones outside the bucket's largest group against all. Buckets with few of them
   are joined to pairs; the others are cut into blocks of a bounded number of shingles, and a task
   compares two blocks at a time: sketches rule pairs out, full sets confirm the rest, and only
   links that join groups which the task has not joined yet leave it. So a group of copies costs rows
   in proportion to its members, and no two groups with a link between them stay apart.

A pair at the threshold shares no bucket with a chance of (1 - 0.75**4)**32 = 5e-6, and is ruled out
by its sketches, whose estimate must fall below ``LEAST_ESTIMATE`` (more than 89 of 256 bits set), with
one of 1.4e-7 more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm import bytewords as bw
from seqloom.llm.common import Scratch, pruned_by_bloom, ready_for_python, setting
from seqloom.llm.components import components

BANDS, ROWS_PER_BAND, SKETCH_BITS = 32, 4, 256
SAMPLES = BANDS * ROWS_PER_BAND
#: Percent of the union that the intersection of linked sets has at least.
THRESHOLD = 75
#: Pairs whose sketches estimate less than this similarity are not confirmed.
LEAST_ESTIMATE = 0.4
ROUNDS = 1
#: Buckets with at most so many pairs per member are joined to pairs.
PAIRS_PER_MEMBER = 2
#: Shingles of the texts in a block, about; a longer text is a block of its own.
BLOCK_SHINGLES = 50_000

_U, _W = np.uint64, np.uint32
_rng = np.random.default_rng(7)
_FLIP = _rng.integers(0, 2**32, SAMPLES, dtype=np.uint64).astype(_W)
_FACTOR = _rng.integers(0, 2**31, SAMPLES, dtype=np.uint64).astype(_W) * _W(2) + _W(1)
_LANES = np.arange(SAMPLES, dtype=_U) << _U(32)


def minhash(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 samples of each row's shingles; rows must not be empty."""
    folded = (hashes >> _U(32)).astype(_W)
    out = np.empty((len(starts), SAMPLES), _W)
    for j in range(SAMPLES):
        out[:, j] = np.minimum.reduceat((folded ^ _FLIP[j]) * _FACTOR[j], starts)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    parts = samples.reshape(len(samples), BANDS, ROWS_PER_BAND).astype(_U)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), parts.shape[:2]).copy()
    for k in range(ROWS_PER_BAND):
        key = bw.mix(key * _U(0x100000001B3) + parts[:, :, k])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps: every (sample number, sample) flips one bit."""
    bit = (bw.mix(samples.astype(_U) | _LANES) % _U(SKETCH_BITS)).astype(np.int64)
    rows = np.arange(len(samples))[:, None] * SKETCH_BITS
    flips = np.bincount((rows + bit).ravel(), minlength=len(samples) * SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).view(np.int64).reshape(len(samples), -1)


def _sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, shingle hashes, row bounds) of blocks of texts."""
    for first, raw, bounds in bw.blocks(column):
        _, _, hashes, firsts = bw.words(raw, bounds, bw.NOT_SPACE)
        made, at = bw.shingles(hashes, firsts)
        yield first, made, at


def _distinct(made: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, and the row bounds."""
    made = made.copy()
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        made[a:b].sort()
    new = np.ones(len(made), bool)
    if len(made) > 1:
        new[1:] = made[1:] != made[:-1]
    new[at[:-1][np.diff(at) > 0]] = True
    return made[new], np.concatenate(([0], np.cumsum(new)))[at]


def _list_array(values: np.ndarray, width: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * width, pa.int32()), pa.array(values.ravel()))


SIGNATURE = "doc_id bigint, n long, d1 long, d2 long, bands array<long>, sketch array<long>"


def digest(made: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A 64-bit sum that tells the sets of a node apart."""
    return np.add.reduceat(bw.mix(made ^ _U(0x5851F42D4C957F2D)), starts).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.num_rows
        n, d1, d2 = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        bands = np.zeros((rows, BANDS), np.int64)
        sketch = np.zeros((rows, SKETCH_BITS // 64), np.int64)
        for first, made, at in _sets(batch.column(1)):
            made, at = _distinct(made, at)
            sizes = np.diff(at)
            n[first : first + len(sizes)] = sizes
            full = np.flatnonzero(sizes)
            if not len(full):
                continue
            starts = at[:-1][full]
            d1[first + full] = digest(made, starts)
            d2[first + full] = np.add.reduceat(bw.mix(made + _U(0x14057B7EF767814F)), starts).view(np.int64)
            samples = minhash(made, starts)
            bands[first + full] = band_keys(samples)
            sketch[first + full] = odd_sketches(samples)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n), pa.array(d1), pa.array(d2), _list_array(bands, BANDS), _list_array(sketch, SKETCH_BITS // 64)],
            names=["doc_id", "n", "d1", "d2", "bands", "sketch"],
        )


def _list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, made, at in _sets(batch.column(1)):
            made, at = _distinct(made, at)
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(made.view(np.int64)))
            full = np.flatnonzero(np.diff(at))
            d1 = np.zeros(len(at) - 1, np.int64)
            if len(full):
                d1[full] = digest(made, at[:-1][full])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(at) - 1), pa.array(d1), lists], names=["node", "d1", "items"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Linked pairs of rows with both sorted sets."""
    for batch in batches:
        xs, ys = batch.column(2), batch.column(3)
        good = np.zeros(batch.num_rows, bool)
        for k in range(batch.num_rows):
            good[k] = _linked(xs[k].values.to_numpy(zero_copy_only=False), ys[k].values.to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(good))


def _members(block: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    """Nodes, groups, bands, sketches and sorted sets of the members of a block."""
    flat = lambda name: block.field(name)
    wide = lambda name: flat(name).flatten().to_numpy(zero_copy_only=False).reshape(len(block), -1)
    lists = flat("items")
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    sets = [values[x:y] for x, y in zip(at[:-1], at[1:], strict=True)]
    return flat("node").to_numpy(), flat("group").to_numpy(), wide("bands"), wide("sketch"), sets


def _linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = np.concatenate((x, y))
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= THRESHOLD * (len(both) - shared)


def _label(parent: dict[int, int], group: int) -> int:
    while group in parent:
        group = parent[group]
    return group


def _compare_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the members of two blocks, or inside one, found at the first band they share.

    Only links that join groups which no earlier link of the task joined leave it, and only members that are
    still apart are compared: a task returns fewer links than it has seen groups.
    """
    most = int((1 - np.exp((LEAST_ESTIMATE - 1) * 4 * SAMPLES / SKETCH_BITS)) * SKETCH_BITS / 2)
    parent: dict[int, int] = {}
    for batch in batches:
        found: tuple[list, list] = ([], [])
        for k in range(batch.num_rows):
            band, xs = batch.column(0)[k].as_py(), _members(batch.column(1)[k].values)
            alone = not batch.column(2)[k].is_valid
            ys = xs if alone else _members(batch.column(2)[k].values)
            labels = [np.array([_label(parent, g) for g in side[1].tolist()], np.int64) for side in ((xs,) if alone else (xs, ys))]
            mine, theirs = labels[0], labels[-1]
            for i in range(len(xs[0])):
                open_ = theirs != mine[i]
                if alone:
                    open_[: i + 1] = False
                at = np.flatnonzero(open_)
                at = at[np.bitwise_count(ys[3][at] ^ xs[3][i]).sum(1) <= most]
                if band:
                    at = at[~(ys[2][at, :band] == xs[2][i, :band]).any(1)]
                for j in at.tolist():
                    old, new = int(theirs[j]), int(mine[i])
                    if old == new or not _linked(xs[4][i], ys[4][j]):
                        continue
                    found[0].append(int(xs[0][i]))
                    found[1].append(int(ys[0][j]))
                    parent[old] = new
                    for side in labels:
                        side[side == old] = new
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])


def estimate(x: Column, y: Column) -> Column:
    """Similarity that the exclusive-or of two odd sketches tells."""
    ones = sum((F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(1, SKETCH_BITS // 64)), F.bit_count(x[0].bitwiseXOR(y[0])))
    left = F.greatest(1 - 2 * ones / SKETCH_BITS, F.lit(1 / SKETCH_BITS))
    return 1 + F.log(left) * (SKETCH_BITS / (4 * SAMPLES))


def confirm(scratch: Scratch, docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of class ids whose full shingle sets meet the threshold."""
    nodes = pairs.select(F.col("a").alias("node"), "alike").union(pairs.select("b", "alike"))
    wanted = scratch.cut(nodes.groupBy("node").agg(F.max("alike").alias("alike"))).filter(F.col("alike") >= LEAST_ESTIMATE)
    with pruned_by_bloom(docs.sparkSession):
        texts = docs.join(wanted, docs["doc_id"] == wanted["node"], "left_semi")
        sets = scratch.cut(texts.mapInArrow(_list_sets, "node long, d1 long, items array<long>"))
    one = sets.select(F.col("node").alias("a"), F.col("items").alias("x"))
    two = sets.select(F.col("node").alias("b"), F.col("items").alias("y"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    links = scratch.cut(met.mapInArrow(_compare, "a long, b long"))
    scratch.drop(sets, wanted)
    return links


def mixed_buckets(buckets: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Rows of the buckets that hold several groups, with their group and the bucket's largest one."""
    if groups is None:
        placed = buckets.withColumn("group", F.col("node"))
    else:
        placed = buckets.join(groups, "node", "left").withColumn("group", F.coalesce("component", "node")).drop("component")
    parts = placed.groupBy("band", "key", "group").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("band", "key").agg(
        F.max(F.struct("size", F.xxhash64("group", "band").alias("by"), "group")).alias("t"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("size").alias("size"),
    )
    mixed = largest.filter("parts > 1").select(
        "band", "key", F.col("t.group").alias("top"), "size", (F.col("size") - F.col("t.size")).alias("outside")
    )
    return placed.join(mixed, ["band", "key"])


def best_pivots(placed: DataFrame, number: int) -> DataFrame:
    """(a, b, alike): for each member outside a bucket's largest group the pivot most like it.

    The pivot of a bucket is drawn from its largest group, another one in each round.
    """
    drawn = F.struct(F.xxhash64("node", "band", F.lit(number)).alias("by"), "node", "sketch")
    pivots = placed.filter("group = top").groupBy("band", "key").agg(F.min(drawn).alias("p"))
    pivots = pivots.select("band", "key", F.col("p.node").alias("a"), F.col("p.sketch").alias("sa"))
    met = placed.filter("group <> top").join(pivots, ["band", "key"]).withColumn("alike", estimate(F.col("sa"), F.col("sketch")))
    best = met.groupBy("node").agg(F.max(F.struct("alike", "a")).alias("m"))
    return best.select(F.col("m.a").alias("a"), F.col("node").alias("b"), "m.alike").filter(F.col("alike") >= LEAST_ESTIMATE)


def merge_groups(scratch: Scratch, groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links; only the groups that they join are worked on."""
    one = groups.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    two = groups.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    known = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    joined = scratch.cut(components(scratch, known))
    old = groups.join(joined.select(F.col("node").alias("component"), F.col("component").alias("label")), "component", "left")
    old = old.select("node", F.coalesce("label", "component").alias("component"))
    return old.unionByName(joined.join(groups.select("node"), "node", "left_anti"))


def split_by_pairs(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    linear = F.col("outside") * F.col("size") <= PAIRS_PER_MEMBER * F.col("size")
    return placed.filter(linear), placed.filter(~linear)


def pairs_in_buckets(placed: DataFrame) -> DataFrame:
    """(a, b, alike) of different groups that share a bucket and whose sketches do not rule a link out."""
    one = placed.filter("group <> top").select("band", "key", F.col("node").alias("a"), F.col("sketch").alias("sa"), F.col("group").alias("ga"))
    apart = (F.col("ga") != F.col("group")) & ((F.col("group") == F.col("top")) | (F.col("a") < F.col("node")))
    met = placed.join(one, ["band", "key"]).filter(apart).withColumn("alike", estimate(F.col("sa"), F.col("sketch")))
    met = met.filter(F.col("alike") >= LEAST_ESTIMATE)
    return met.groupBy(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).agg(F.max("alike").alias("alike"))


def confirm_in_blocks(scratch: Scratch, docs: DataFrame, member: DataFrame, placed: DataFrame) -> DataFrame:
    """Links (a, b) between different groups of the buckets of ``placed``."""
    spark = docs.sparkSession
    nodes = scratch.cut(placed.groupBy("node").agg(F.lit(1.0).alias("alike"))).filter(F.col("alike") >= LEAST_ESTIMATE)
    with pruned_by_bloom(spark):
        texts = docs.join(nodes, docs["doc_id"] == nodes["node"], "left_semi")
        sets = scratch.cut(texts.mapInArrow(_list_sets, "node long, d1 long, items array<long>"))
    top = F.col("group") == F.col("top")
    shares = placed.groupBy("band", "key", top.alias("is_top")).agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("blocks"))
    cut = placed.withColumn("is_top", top).join(shares, ["band", "key", "is_top"])
    cut = cut.select("band", "key", "is_top", F.pmod(F.xxhash64("node"), "blocks").alias("block"), "node", "group").distinct()
    # a node stands for all texts of its id, as where pairs are joined
    full = cut.join(member.select("node", "d1", "bands", "sketch"), "node").join(sets.dropDuplicates(["node", "d1"]), ["node", "d1"])
    listed = full.groupBy("band", "key", "is_top", "block").agg(
        F.collect_list(F.struct("node", "group", "bands", "sketch", "items")).alias("x")
    )
    listed = scratch.cut(listed)
    other = listed.select("band", "key", F.col("is_top").alias("top_y"), F.col("block").alias("block_y"), F.col("x").alias("y"))
    later = (~F.col("is_top")) & (F.col("top_y") | (F.col("block") < F.col("block_y")))
    two = listed.join(other, ["band", "key"]).filter(later).select("band", "x", "y")
    alone = listed.filter(~F.col("is_top")).select("band", "x", F.lit(None).cast(listed.schema["x"].dataType).alias("y"))
    with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "8"):
        links = scratch.cut(alone.unionByName(two).mapInArrow(_compare_blocks, "a long, b long"))
    scratch.drop(listed, sets, nodes)
    return links


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Null and empty texts, and texts of white space, have an empty set and no links. Rows that share
    an id count as one document that holds all their texts. A row without an id is linked with
    nothing: its ``component_id`` is null and it is kept. Where whole rows repeat, each is returned.
    An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    ready_for_python(spark)
    scratch = Scratch(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = scratch.cut(slim.mapInArrow(_sign, SIGNATURE))
    usable = signed.filter("n > 0 AND doc_id IS NOT NULL")
    classes = usable.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("node"))
    classes = scratch.cut(classes)
    member = classes.join(usable.withColumnRenamed("doc_id", "node"), ["node", "n", "d1", "d2"]).dropDuplicates(["node", "n", "d1", "d2"])
    member = scratch.cut(member.select("node", "n", "d1", "bands", "sketch"))
    banded = member.select("node", "n", "sketch", F.posexplode("bands").alias("band", "key"))

    buckets = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").drop("size")
    buckets = scratch.cut(banded.join(buckets, ["band", "key"]))
    groups, links = None, None
    for number in range(ROUNDS):
        placed = scratch.cut(mixed_buckets(buckets, groups))
        stars = scratch.cut(best_pivots(placed, number))
        made = confirm(scratch, slim, stars)
        links = made if links is None else links.unionByName(made)
        groups = scratch.cut(components(scratch, links))
        scratch.drop(placed, stars)
    placed = scratch.cut(mixed_buckets(buckets, groups))
    few, many = split_by_pairs(placed)
    rest = scratch.cut(pairs_in_buckets(few))
    scratch.drop(buckets)
    made = confirm(scratch, slim, rest).unionByName(confirm_in_blocks(scratch, slim, member, many))
    groups = scratch.cut(merge_groups(scratch, groups, made))
    scratch.drop(placed, rest, member, links, made)

    # classes of one id are one document, so a class takes the smallest label of its node
    labels = classes.join(groups, "node", "left").select("n", "d1", "d2", F.coalesce("component", "node").alias("component"))
    rows = signed.select("doc_id", "n", "d1", "d2").join(labels, ["n", "d1", "d2"], "left")
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), own)
    return rows.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose id is the smallest of its near-duplicate group."""
    judged = near_groups(docs, id_col, text_col)
    gone = judged.filter(~F.col("kept")).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)
