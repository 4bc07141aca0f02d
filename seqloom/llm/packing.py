"""Best-fit packing of tokenised documents by minimum bin slack.

Pieces are at most ``MAX_TOKENS`` long, so their lengths form a histogram of at most that many rows,
whatever the corpus holds. The packing is planned on that histogram: for each sequence the longest
piece left is taken, a bitset of reachable sums over the other lengths left finds the fullest
combination that fits with it, and the combination is removed, as many times over as the counts
allow. The plan is a bounded table of patterns. Pieces are then numbered inside their length and
take the places the patterns give to those numbers, by a join; no task sees a whole length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, ready_for_python
from seqloom.llm.tokens import tokens

MAX_TOKENS = 1024
END_OF_DOCUMENT = 2
#: Pieces of one length that one task numbers.
PIECES_PER_TASK = 100_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def _cut_documents(folder: str | None, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens(folder).encode
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "")
                ids.append(END_OF_DOCUMENT)
                view = memoryview(ids).cast("B")
                at, end = 0, len(ids) % most or most
                for piece in range(-(-len(ids) // most)):
                    for column, value in zip(out, (doc, piece, at, end - at, zlib.crc32(view[4 * at : 4 * end])), strict=True):
                        column.append(value)
                    at, end = end, end + most
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def cut_documents(docs: DataFrame, most: int = MAX_TOKENS, folder: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    The ids of a document are those of its text and one end mark; a null or empty text has the end
    mark alone. Only documents of more than ``most`` ids are cut, into pieces of ``most`` of which
    the first may be shorter.
    """
    ready_for_python(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_cut_documents(folder, most), PIECES)


def fullest(counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """(length, uses) whose sum is the largest that fits in ``room``, longest lengths first."""
    if not counts or room < min(counts):
        return []
    reach, steps, full = 1, [], 1 << room
    mask = (full << 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length], room // length)):
            grown = (reach | reach << length) & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach & full:
                break
        if reach & full:
            break
    total, uses = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            uses[length] = uses.get(length, 0) + 1
            total -= length
    return sorted(uses.items(), reverse=True)


def plan(histogram: dict[int, int], most: int = MAX_TOKENS) -> list[tuple[int, list[tuple[int, int]]]]:
    """(times, [(length, uses)...]) in the order of sequences; every length is used up exactly."""
    left, patterns = {x: n for x, n in histogram.items() if n}, []
    while left:
        longest = max(left)
        others = dict(left)
        others[longest] -= 1
        if not others[longest]:
            del others[longest]
        uses = {longest: 1}
        for length, n in fullest(others, most - longest):
            uses[length] = uses.get(length, 0) + n
        times = min(left[x] // n for x, n in uses.items())
        patterns.append((times, sorted(uses.items(), reverse=True)))
        for x, n in uses.items():
            left[x] -= times * n
            if not left[x]:
                del left[x]
    return patterns


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, uses, offset) of each length in each pattern."""
    rows, sequence, used = [], 0, {}
    for times, parts in patterns:
        offset = 0
        for length, uses in parts:
            first = used.get(length, 0)
            used[length] = first + times * uses
            rows.append((length, first, used[length], sequence, uses, offset))
            offset += length * uses
        sequence += times
    return rows


def number_in_length(pieces: DataFrame, rows: int) -> DataFrame:
    """``pieces`` with a number ``k`` from 0 inside each length; a length is spread over salted parts."""
    parts = max(1, -(-rows // PIECES_PER_TASK))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.partitionBy("length").orderBy("salt")) - F.col("size")
    shifts = sizes.select("length", "salt", before.alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = salted.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(shifts, ["length", "salt"]).withColumn("k", F.col("own") + F.col("before")).drop("own", "before", "salt")


def pack(pieces: DataFrame, most: int = MAX_TOKENS) -> DataFrame:
    """``pieces`` (a written table) with sequence_id and offset.

    Sequences hold at most ``most`` tokens, without gaps. Repeated rows are packed one by one; an
    empty table gives an empty result. The driver sees the histogram of lengths and the patterns,
    both bounded by ``most``.
    """
    spark = pieces.sparkSession
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = places(plan(histogram, most))
    by_length: dict[int, list] = {}
    for length, *rest in rows:
        by_length.setdefault(length, []).append(tuple(rest))
    # one row per length with its places in order; a piece finds its place in that bounded list
    listed = spark.createDataFrame(
        sorted(by_length.items()),
        "length bigint, slots array<struct<first: bigint, until: bigint, sequence: bigint, uses: bigint, at: bigint>>",
    )
    numbered = number_in_length(pieces, sum(histogram.values()))
    slot = F.filter("slots", lambda s: (s["first"] <= F.col("k")) & (F.col("k") < s["until"]))[0]
    put = numbered.join(F.broadcast(listed), "length").withColumn("slot", slot)
    nth = F.col("k") - F.col("slot.first")
    return put.select(
        *pieces.columns,
        (F.col("slot.sequence") + F.floor(nth / F.col("slot.uses"))).cast("long").alias("sequence_id"),
        (F.col("slot.at") + F.pmod(nth, F.col("slot.uses")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, most: int = MAX_TOKENS, folder: str | None = None) -> DataFrame:
    """Pieces of whole documents (see ``cut_documents``) with their places (see ``pack``)."""
    return pack(Scratch(docs.sparkSession).cut(cut_documents(docs, most, folder)), most)
