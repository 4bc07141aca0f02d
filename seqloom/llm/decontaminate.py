"""Passages of benchmark items in documents: SimHash of item-sized windows and Hamming blocks.

A window of a document has as many 5-word shingles as an item, and one that is similar to the item
holds at least ``SIMILARITY`` of the item's. So it holds one of any shingles that make up more than
the rest of the item; windows are laid only around the ones that are rarest in the documents. What
many items and many documents share, such as an instruction, is never looked up unless an item
consists of little else. A window need not begin at a shingle that no item has, except at the end of
the document: the next one shares as much and perhaps more. Each window and item gets a 64-bit
SimHash of its weighted shingles. The fingerprints are cut into 8 blocks; of two within 23 bits of
each other some block differs in 2 bits at most, so items are listed under all values that near for
each block, and an equi-join finds every pair within the radius. Pairs are then verified by the exact
weighted Jaccard similarity of their shingles. Everything is DataFrame operations.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, pruned_by_bloom, settled, whole_text

WIDTH = 5
SIMILARITY = 0.75
#: Hamming radius. At the similarity of 0.75 the expected distance is 11 bits, its deviation 3.
RADIUS, BLOCKS, BLOCK_BITS, NEAR = 23, 8, 8, 2
_LANES, _LANE_BITS = 16, 16
_ONES = sum(1 << (k * _LANE_BITS) for k in range(64 // _LANE_BITS))


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def shingle_hashes(width: int) -> Column:
    """Hashes of all runs of ``width`` words of the column ``words``, in order."""
    last = F.size("words") - width
    hashed = F.transform("words", lambda w, i: F.xxhash64(w, *[F.get("words", i + k) for k in range(1, width)]))
    return F.when(last >= 0, F.slice(hashed, 1, last + 1)).otherwise(F.array().cast("array<long>"))


#: Columns over ``own``, the sorted hashes: a shingle that stands n times becomes n elements, so set
#: operations on them heed weights.
ELEMENTS = "transform(own, (x, i) -> xxhash64(x, CAST(i + 1 - array_position(own, x) AS int)))"
#: How many elements have each bit, in 16-bit lanes, four to a number.
COUNTS = f"""transform(sequence(0, {_LANES - 1}), j -> aggregate(elements, 0L,
    (a, x) -> a + (shiftrightunsigned(x, j) & {_ONES}L)))"""
#: The SimHash: the majority of each bit.
PRINT = f"""aggregate(sequence(0, 63), 0L, (a, b) -> a | shiftleft(
    IF(2 * (shiftrightunsigned(counts[b % {_LANES}], CAST(b div {_LANES} AS int) * {_LANE_BITS}) & {(1 << _LANE_BITS) - 1}L)
       > size(elements), 1L, 0L), b))"""


def with_elements(df: DataFrame) -> DataFrame:
    """``df`` with its column ``own`` of shingle hashes turned into ``elements``."""
    return settled(settled(df.withColumnRenamed("own", "_any"), own=F.sort_array("_any")), elements=F.expr(ELEMENTS)).drop("_any", "own")


def with_prints(df: DataFrame) -> DataFrame:
    """``df`` with its column ``own`` of shingle hashes turned into ``elements`` and ``print``."""
    return settled(settled(with_elements(df), counts=F.expr(COUNTS)), print=F.expr(PRINT)).drop("counts")


def blocks_of(print_: Column) -> Column:
    cut = [F.shiftrightunsigned(print_, k * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)) for k in range(BLOCKS)]
    return F.array(*cut)


def near_values() -> list[int]:
    """Masks of up to ``NEAR`` flipped bits of a block."""
    return [sum(1 << b for b in bits) for n in range(NEAR + 1) for bits in combinations(range(BLOCK_BITS), n)]


def _key() -> Column:
    """The id, or a number of the text's own where a row has none."""
    own = -1 - F.xxhash64(whole_text()).bitwiseAND(F.lit((1 << 62) - 1))
    return F.coalesce(F.col("doc_id").cast("long"), own)


def shingled(texts: DataFrame, widths: list[int]) -> DataFrame:
    """A row of ``width`` and ``hashes`` for each width, in place of ``text``; a text is split once."""
    by_width = [F.struct(F.lit(w).alias("width"), shingle_hashes(w).alias("hashes")) for w in widths]
    rest = [c for c in texts.columns if c != "text"]
    return settled(texts, words=words_of(F.col("text"))).select(*rest, F.inline(F.array(*by_width)))


def rare_shingles(hits: DataFrame, occurs: DataFrame) -> DataFrame:
    """(width, m, h): for each item its shingles that are rarest among ``hits``, as few as make up more
    than ``1 - SIMILARITY`` of it. A window without any of them cannot be similar to the item.

    ``hits`` has a row (width, h) for each place in the documents, ``occurs`` (item_id, width, m, h, n)
    for each different shingle of an item. Shingles that stand in no document rank first and are left
    out of the result.
    """
    often = hits.groupBy("width", "h").agg(F.count("*").alias("places"))
    ranked = occurs.join(often, ["width", "h"], "left").fillna(0, ["places"])
    before = F.expr("sum(n) OVER (PARTITION BY item_id ORDER BY places, h ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n")
    needed = ranked.withColumn("before", before).filter(F.col("before") <= (1 - SIMILARITY) * F.col("m"))
    return needed.filter("places > 0").select("width", "m", "h").distinct()


def windows_around(hits: DataFrame, rare: DataFrame) -> DataFrame:
    """(key, width, m, start) of the windows that hold a rare shingle of an item of their length and
    begin at a shingle of some item, or end with the document.

    ``hits`` has (key, width, size, pos, h); a document of ``size`` shingles, fewer than ``m``, is one window.
    """
    near = hits.join(rare, ["width", "h"]).filter(F.col("size") >= SIMILARITY * F.col("m"))
    before = F.expr("lag(pos, 1, -1) OVER (PARTITION BY key, width, m, size ORDER BY pos)")
    last = F.greatest(F.col("size") - F.col("m"), F.lit(0))
    spans = near.select("key", "width", "m", "size", "pos", before.alias("before"), last.alias("last"))
    spans = spans.withColumns({"low": F.greatest(F.lit(0), F.expr("pos - m + 1"), F.expr("before + 1")), "high": F.least("pos", "last")})
    laid = spans.filter("low <= high").select("key", "width", "m", "last", F.explode(F.sequence("low", "high")).alias("start"))
    begun = laid.join(hits.select("key", "width", F.col("pos").alias("start")), ["key", "width", "start"], "left_semi")
    return begun.unionByName(laid.filter("start = last")).select("key", "width", "m", "start").distinct()


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(key, item_id, start, m, similarity): the best window of each item in each document.

    ``start`` counts shingles from 0, ``m`` is the number of shingles of the item. Items of fewer
    than 5 words are one shingle of all their words; items without words, null or empty texts match
    nothing. ``key`` is the doc_id, or a negative number made of the text where that is null; rows
    that share an id are judged together. Repeated items are found each under its id; of items with
    a null id nothing is returned. Empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    items = benchmark.filter("item_id IS NOT NULL").select("item_id", whole_text().alias("text"))
    items = shingled(settled(items, own_width=F.least(F.size(words_of(F.col("text"))), F.lit(WIDTH))), list(range(1, WIDTH + 1)))
    items = items.filter("width = own_width").withColumn("m", F.size("hashes")).drop("own_width").withColumnRenamed("hashes", "own")
    items = scratch.cut(with_prints(items.withColumn("hashes", F.col("own"))))
    widths = sorted(r.width for r in items.select("width").distinct().collect()) or [WIDTH]  # five at most
    occurs = items.select("item_id", "width", "m", F.explode("hashes").alias("h"))
    occurs = scratch.cut(occurs.groupBy("item_id", "width", "m", "h").agg(F.count("*").alias("n")))

    texts = docs.select(_key().alias("key"), whole_text().alias("text"))
    placed = shingled(texts, widths).select("key", "width", F.size("hashes").alias("size"), F.posexplode("hashes").alias("pos", "h"))
    hits = scratch.cut(placed.join(occurs.select("width", "h").distinct(), ["width", "h"], "left_semi"))
    windows = scratch.cut(windows_around(hits, scratch.cut(rare_shingles(hits, occurs))))
    scratch.drop(hits)

    with pruned_by_bloom(spark):
        asked_for = texts.join(windows.filter("m > 0").select("key"), "key", "left_semi")
        few = scratch.cut(shingled(asked_for.dropDuplicates(["key", "text"]), widths))
    own = F.expr("slice(hashes, start + 1, m)").alias("own")
    printed = with_prints(few.join(windows, ["key", "width"]).select("key", "width", "m", "start", own).filter("size(own) > 0"))
    printed = scratch.cut(printed.select("key", "width", "m", "start", "print").distinct())
    listed = items.select("item_id", "width", "m", F.col("print").alias("item_print"))
    listed = listed.select("*", F.posexplode(blocks_of(F.col("item_print"))).alias("block", "value"))
    listed = listed.withColumn("flip", F.explode(F.array(*[F.lit(v).cast("long") for v in near_values()])))
    listed = listed.withColumn("value", F.col("value").bitwiseXOR(F.col("flip"))).drop("flip")
    asked = printed.select("*", F.posexplode(blocks_of(F.col("print"))).alias("block", "value"))
    near = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS
    found = asked.join(scratch.cut(listed), ["width", "m", "block", "value"]).filter(near)
    found = scratch.cut(found.select("key", "width", "m", "start", "item_id").distinct())

    pairs = with_elements(few.join(found, ["key", "width"]).select("key", "item_id", "m", "start", own))
    pairs = pairs.join(items.select("item_id", F.col("elements").alias("item_elements")), "item_id")
    pairs = settled(pairs, shared=F.size(F.array_intersect("elements", "item_elements")))
    similarity = F.col("shared") / (F.size("elements") + F.size("item_elements") - F.col("shared"))
    pairs = pairs.withColumn("similarity", similarity).filter(F.col("similarity") >= SIMILARITY)
    best = pairs.groupBy("key", "item_id").agg(F.max(F.struct("similarity", (-F.col("start")).alias("before"), "m")).alias("b"))
    return best.select("key", "item_id", (-F.col("b.before")).alias("start"), "b.m", "b.similarity")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no benchmark passage was found."""
    keys = find_leaks(docs, benchmark).select(F.col("key").alias("_leak")).distinct()
    return docs.join(keys, _key() == F.col("_leak"), "left_anti").select(*docs.columns)
