"""Spelling variants: words one edit apart, found by sorting rotations of marked words.

A word w is marked with a terminator, ``w|``, and turned so that each place comes last once. The turn
that ends in the character at a place begins with all the rest of the word: words that differ by a
replacement there share that beginning, and a word that lacks the character *is* that beginning. So
turns are sorted by what stands before their last character; each group of equal beginnings holds at
most one word that is the beginning itself and, for each character, one word with that character in the
skipped place. All members of a group are near each other and nothing else is.

A deletion inside a run of equal characters could be seen at each of them; it counts at the first. Then
each near pair meets in one group and groups can be counted: a member's near words are the others, and
its best one is the first of the sorted group, or the second for the first itself. No pair is written.

A group has no more members than the words have different characters, but nothing relies on it: a
window scans a sorted group and spills what does not fit. No group is gathered into a list.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqloom.llm.common import Scratch, ready_for_python

#: Maximal runs of these letters are words (U+00C0 to U+00FF in UTF-8), A-Z onto a-z.
LETTER = rb"[a-z]|\xc3[\x80-\xbf]"
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
MIN_LENGTH = 7
MIN_COUNT = 2
ONE_SLIP_IN = 31
RATIO = 10
#: Stands for the end of a word; no letter.
TERMINATOR = "|"
#: Distinct words that a task sums before it hands them on.
MOST_WORDS = 200_000


def slipped(doc_id: object, run: bytes, one_in: int) -> bytes:
    """The run as it is read in a document: one of its letters is lost where the checksum says so."""
    h = zlib.crc32(run, zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    if h % one_in:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, one_slip_in: int = ONE_SLIP_IN) -> DataFrame:
    """(word, n): occurrences of each word of at least ``min_length`` letters in all texts.

    Sums are kept by task while they are few, so frequent words reach the shuffle as few rows. A null
    text has no words; a null id counts as an empty one; repeated rows count each.
    """
    ready_for_python(docs.sparkSession)
    # shorter runs only get shorter, so the pattern skips them
    found = re.compile(rb"(?:%s){%d,}" % (LETTER, min_length)).findall

    def rows(summed: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode() for w in summed], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(summed.values(), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summed: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                own = doc_id.as_py()
                for word, n in Counter(found(text.as_buffer().to_pybytes().translate(LOWER))).items():
                    word = slipped(own, word, one_slip_in)
                    if len(word) >= min_length and (len(word) >= 2 * min_length or len(word.decode()) >= min_length):
                        summed[word] += n
                if len(summed) >= MOST_WORDS:
                    yield rows(summed)
                    summed = Counter()
        yield rows(summed)

    counted = docs.select("doc_id", "text").mapInArrow(run, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").cast("long").alias("n"))


def turns(words: DataFrame) -> DataFrame:
    """(rest, lacks, lead, word, n): every turn of every marked word, as the beginning of longer words'
    turns (``lacks``) and by what stands before its last character; ``lead`` tells the first of equal
    characters in a row."""
    marked = F.concat("word", F.lit(TERMINATOR))
    places = F.sequence(F.lit(1), F.length("word"))
    each = words.select("word", "n", F.explode(places).alias("_at"), marked.alias("_marked"))
    # the turn that ends in the character at _at: what follows it, then what stands before it
    rest = F.expr("concat(substring(_marked, _at + 1), substring(_marked, 1, _at - 1))")
    # the turn that begins with that character, whole
    whole = F.expr("concat(substring(_marked, _at), substring(_marked, 1, _at - 1))")
    lead = F.expr("_at = 1 OR substring(_marked, _at, 1) <> substring(_marked, _at - 1, 1)")
    kinds = F.array(
        F.struct(rest.alias("rest"), F.lit(False).alias("lacks"), lead.alias("lead")),
        F.struct(whole.alias("rest"), F.lit(True).alias("lacks"), F.lit(True).alias("lead")),
    )
    first = words.select("word", "n", F.concat(F.lit(TERMINATOR), "word").alias("rest"), F.lit(True).alias("lacks"), F.lit(True).alias("lead"))
    return each.select("word", "n", F.inline(kinds)).select("rest", "lacks", "lead", "word", "n").unionByName(first)


def near(words: DataFrame) -> DataFrame:
    """(word, n_near, best): how many words are one edit away, and the one of largest n as (n, word);
    words without any are left out. Ties go to the smallest word in code-point order."""
    rank = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    # parts of the sorted order: equal beginnings stand together and go to one task
    sorted_turns = turns(words).withColumn("_rank", rank).repartitionByRange("rest")
    group = Window.partitionBy("rest")
    inside = group.orderBy("lacks", "_rank")
    place = lambda c: F.when(~F.col("lacks"), c)

    scanned = (
        sorted_turns.withColumn("_size", F.count("*").over(group))
        .filter("_size > 1")
        .withColumns(
            {
                "_full": F.min(F.when(F.col("lacks"), F.col("_rank"))).over(group),
                "_lead_best": F.min(F.when(~F.col("lacks") & F.col("lead"), F.col("_rank"))).over(group),
                "_leads": F.count(F.when(~F.col("lacks") & F.col("lead"), 1)).over(group),
                "_best": F.min(place(F.col("_rank"))).over(group),
                "_place": F.row_number().over(inside),
                "_with": F.count(place(F.lit(1))).over(group),
            }
        )
        .withColumn("_second", F.min(F.when(~F.col("lacks") & (F.col("_place") == 2), F.col("_rank"))).over(group))
    )
    others = F.when(F.col("_place") == 1, F.col("_second")).otherwise(F.col("_best"))
    full = F.when(F.col("lead"), F.col("_full"))
    met = scanned.select(
        "word",
        F.when(F.col("lacks"), F.col("_leads")).otherwise(F.col("_with") - 1 + F.when(full.isNotNull(), 1).otherwise(0)).alias("n_near"),
        F.when(F.col("lacks"), F.col("_lead_best")).otherwise(F.least(others, full)).alias("best"),
    )
    return met.filter("n_near > 0").groupBy("word").agg(F.sum("n_near").cast("long").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root) for (word, form): follow forms to the last. Each round doubles the reach; a form is
    ``RATIO`` times as frequent, so chains are as short as the number of digits of a count."""
    reach = scratch.cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = reach.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = scratch.cut(reach.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        if moved.filter("_moved").isEmpty():
            return reach
        scratch.drop(reach)
        reach = moved.drop("_moved")


def group_variants(counts: DataFrame, ratio: int = RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words that occur ``min_count`` times or more.

    ``counts`` has distinct words and their numbers (word, n), null words left out; any letters but the
    terminator. An empty table gives none.
    """
    scratch = Scratch(counts.sparkSession)
    words = scratch.cut(counts.filter(F.col("word").isNotNull() & (F.col("n") >= min_count)).select("word", "n"))
    found = near(words)
    is_form: Column = -F.col("best.less") >= ratio * F.col("n")
    joined = words.join(found, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"),
        F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    held = scratch.cut(joined)
    ends = roots(held.filter("form IS NOT NULL"), scratch)
    return held.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
