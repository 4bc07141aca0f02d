"""Per-namespace evaluation of ranked term predictions (Jiang et al. 2016)."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from seqloom.operators import graph
from seqloom.operators import lists as L
from seqloom.operators.lineage import cut_lineage, cuts_dropped
from seqloom.operators.ordering import MOST_RANGES, keep_first, number_rows
from seqloom.session import ship_package

NORMS = ("cafa", "pred", "gt")
#: Cells of proteins, before repeats are folded, that a task gets about.
TASK_CELLS = 1 << 23
#: Such cells of one slice of the proteins, or as many as the lists hold that every slice needs. Slices follow each other,
#: and a slice leaves the disks with its sums.
SLICE_CELLS = 1 << 29
#: Entries of lists that a round of the closure has on their way at a time, about, and per term at least.
PIECE_PAIRS, PIECE_PAIRS_A_TERM = 1 << 28, 128
#: Targets that most terms reach; lists of them that are sent by number, the entries of these in all and of one at most.
SHARED_TARGETS, SHARED_LISTS, SHARED_ENTRIES, LONGEST_SHARED = 1 << 12, 1 << 15, 1 << 21, 1 << 9
#: Terms, about, in whose paths targets are counted to find the common ones.
COUNTED_TERMS = 1 << 14
#: What the rows of a protein and a level change, per namespace, in the order in which they are summed up.
VALUES = ("covered", "pr", "rc", "wpr", "wrc", "mi", "found_w", "tp", "np", "wnp")


@dataclass(frozen=True)
class EvalOptions:
    step: float = 0.01
    norm: str = "cafa"
    fill: bool = False
    max_terms: int | None = None
    no_orphans: bool = False


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _folded_terms(terms, edges, toi, opt):
    """(target, namespace, code, copies, ia): the terms whose cells count, numbered by namespace; repeated rows are folded."""
    wanted = terms.select("term", "namespace", "ia")
    if toi is not None:
        wanted = wanted.join(toi.select("term").hint("merge"), "term", "left_semi")
    if opt.no_orphans:
        # as many edges as there are: files of ids are small for what they hold, so their size would have them broadcast
        wanted = wanted.join(edges.select(F.col("child").alias("term")).hint("merge"), "term", "left_semi")
    weight = F.coalesce("ia", F.lit(1.0))
    folded = wanted.groupBy(F.col("term").alias("target"), "namespace").agg(F.count("*").alias("copies"), F.sum(weight).alias("ia"))
    # written first, so that the ranges follow its size and not a guess about the joins before it
    numbered = number_rows(cut_lineage(folded), ["namespace", "copies", "target"], name="code")
    return cut_lineage(numbered.withColumn("code", F.col("code").cast("int")))


def _coded(wanted, terms, edges):
    """(names: term, node, own codes with their weights; edges from nodes to codes with the weights of these).

    A target has a code for each of its namespaces, the first of which stands for it as a child. Terms that do not count
    have codes after all others.
    """
    ids = terms.select("term").unionByName(edges.select(F.col("child").alias("term"))).unionByName(edges.select(F.col("parent").alias("term")))
    others = ids.distinct().filter("term IS NOT NULL").join(wanted.select(F.col("target").alias("term")).hint("merge"), "term", "left_anti")
    after = number_rows(cut_lineage(others), ["term"], name="code").select("term", (F.col("code") + wanted.count()).cast("int").alias("code"))
    after = cut_lineage(after)
    own = F.sort_array(F.collect_list(F.struct("code", "ia"))).alias("own")
    names = wanted.filter("target IS NOT NULL").groupBy(F.col("target").alias("term")).agg(F.min("code").alias("node"), own)
    none = F.array().cast(names.schema["own"].dataType)
    names = cut_lineage(names.unionByName(after.select("term", F.col("code").alias("node"), none.alias("own"))))
    ends = wanted.select(F.col("target").alias("parent"), F.col("code"), "ia").unionByName(
        after.select(F.col("term").alias("parent"), "code", F.lit(0.0).alias("ia"))
    )
    children = names.select(F.col("term").alias("child"), "node")
    # terms are as many as their files hold, however well these are packed
    coded = edges.select("child", "parent").distinct().join(children.hint("merge"), "child").join(ends.hint("merge"), "parent")
    return names, coded.select(F.col("node").alias("child"), F.col("code").alias("parent"), F.col("ia").alias("weight"))


def _split(last, common):
    """Lists of ancestors to the targets that count (codes up to ``last``): those near a term and the ``common`` ones."""

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            codes, weights, lens = L.entries(table, "codes"), L.entries(table, "weights"), L.lengths(table, "codes")
            row = np.repeat(np.arange(len(lens)), lens)
            counts, shared = codes <= last, np.isin(codes, common, kind="table") if len(common) else np.zeros(len(codes), bool)
            out = [table.column("node").combine_chunks()]
            for some in (counts & ~shared, counts & shared):
                sizes = np.bincount(row[some], minlength=len(lens))
                out += [L.list_array(codes[some], sizes), L.list_array(weights[some], sizes)]
            yield pa.RecordBatch.from_arrays(out, names=["node", "near_codes", "near_weights", "upper_codes", "upper_weights"])

    return run


def _target_lists(wanted, terms, edges):
    """(lists of what a term reaches, lists that many terms share).

    The first has term, n_own, codes, weights, cells, shared: a term's targets and their weights as lists, itself first
    (``n_own`` entries), and the number of a shared list (shared, upper_codes, upper_weights) with the rest of them. Terms mostly
    differ in what is near them; what they reach among the targets most terms reach is the same for many.
    What is shared is bounded; a term whose common targets are in no shared list has all in its own.
    """
    with cuts_dropped(terms.sparkSession) as made:
        names, coded = _coded(wanted, terms, edges)
        reach = graph.ancestor_lists(coded, PIECE_PAIRS, PIECE_PAIRS_A_TERM)
        n_wanted, n_terms = wanted.count(), max(1, reach.count())
        some = F.pmod(F.xxhash64("node"), F.lit(max(1, n_terms // COUNTED_TERMS))) == 0
        met = reach.filter(some).select(F.explode("codes").alias("code")).filter(F.col("code") <= n_wanted).groupBy("code").count()
        common = np.array([r.code for r in met.orderBy(F.desc("count"), "code").limit(SHARED_TARGETS).select("code").collect()], np.int32)
        schema = "node int, near_codes array<int>, near_weights array<double>, upper_codes array<int>, upper_weights array<double>"
        split = reach.mapInArrow(_split(n_wanted, common), schema)
        n = F.size("upper_codes")
        sets = split.select("upper_codes").filter((n > 0) & (n <= LONGEST_SHARED)).groupBy("upper_codes").agg((F.count("*") * n).alias("gain"))
        order = [F.desc("gain"), F.asc("upper_codes")]
        best = Window.partitionBy(F.lit(0)).orderBy(*order)  # at most SHARED_LISTS rows, which one task numbers
        upto = F.sum(n).over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        numbered = sets.orderBy(*order).limit(SHARED_LISTS).select("upper_codes", F.row_number().over(best).alias("shared"), upto.alias("entries"))
        numbers = cut_lineage(numbered.filter(F.col("entries") <= SHARED_ENTRIES).select("shared", "upper_codes"))
        weighed = numbers.select("shared", F.explode("upper_codes").alias("code")).join(wanted.select("code", "ia"), "code")
        whole = weighed.groupBy("shared").agg(F.sort_array(F.collect_list(F.struct("code", "ia"))).alias("x"))
        shared = cut_lineage(whole.select("shared", F.col("x.code").alias("upper_codes"), F.col("x.ia").alias("upper_weights")))
        listed = names.join(split.join(numbers, "upper_codes", "left").hint("merge"), "node", "left")
        known = {c: F.coalesce(c, F.array().cast(split.schema[c].dataType)) for c in split.columns[1:]}
        listed = listed.withColumns(known)
        rest = {
            c: F.concat(F.col("own")[f], f"near_{c}", F.when(F.col("shared").isNull(), F.col(f"upper_{c}")).otherwise(F.array().cast(split.schema[f"near_{c}"].dataType)))
            for c, f in (("codes", "code"), ("weights", "ia"))
        }
        cells = (F.size("own") + F.size("near_codes") + F.size("upper_codes")).alias("cells")
        # each row is sent once for every protein that has the term
        mine = cut_lineage(listed.select("term", F.size("own").alias("n_own"), *[v.alias(c) for c, v in rest.items()], cells, "shared").filter("cells > 0"))
        del made[-2:]  # the shared lists and the others
    return mine, shared


def _sides(pred, truth, edges, terms, toi, opt):
    """(terms of judged proteins with score and truth, lists of what a term reaches, shared lists, wanted terms, number of
    cells, of these in the lists)."""
    wanted = _folded_terms(terms, edges, toi, opt)
    lists, shared = _target_lists(wanted, terms, edges)
    raw = pred.filter(F.col("score") > 0).join(truth.select("protein_id"), "protein_id", "left_semi")
    raw = raw.join(terms.select("term", "namespace"), "term")
    if opt.max_terms is not None:
        raw = keep_first(raw, ["protein_id", "namespace"], [F.desc("score"), F.asc("term")], opt.max_terms)
    both = raw.select("protein_id", "term", "score", F.lit(0).alias("is_true")).unionByName(
        truth.select("protein_id", "term", F.lit(None).cast("double").alias("score"), F.lit(1).alias("is_true"))
    )
    both = cut_lineage(both.groupBy("protein_id", "term").agg(F.max("score").alias("score"), F.max("is_true").alias("is_true")))
    n_cells = both.groupBy("term").count().join(lists.select("term", "cells"), "term").agg(F.sum(F.col("count") * F.col("cells"))).first()[0]
    in_lists = lists.agg(F.sum("cells")).first()[0]
    return both, lists, shared, wanted, n_cells or 0, in_lists or 0


@dataclass(frozen=True)
class Cells:
    """Cells of the judged proteins of one slice as lists: protein_id, level (-1: not predicted, ``steps``: not a number),
    is_true, known, n_own, codes, weights; the first codes of ``spaces`` (namespace, copies of a term, first code) tell those of a code.
    """

    rows: DataFrame
    spaces: list
    namespace_type: object
    steps: int
    fill: bool


def _prepare(pred, truth, edges, terms, toi, known, opt):
    """All cells as one table, before repeats are folded."""
    cells = _cells(*_sides(pred, truth, edges, terms, toi, opt)[:-1], known, opt)
    spread = cells.rows.select("protein_id", "level", "is_true", "known", F.inline(F.arrays_zip("codes", "weights")))
    namespace = reduce(lambda name, s: F.when(F.col("codes") >= s.first_code, F.lit(s.namespace)).otherwise(name), cells.spaces, F.lit(None))
    return spread.withColumn("namespace", namespace)


def _cells(both, lists, shared, wanted, n_cells, known, opt, slices=1, number=0):
    """The cells of slice ``number``, dealt by protein.

    Predictions and answers climb the ontology together. What travels to a protein are its terms, each
    with the list of what it reaches, common parts by number; lists are folded to cells where the protein
    is, in as many tasks as there are cells, so cells themselves are never sent. A protein meets in one task. Paths are cut
    to the terms of interest before that.
    """
    shuffles = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(shuffles, min(MOST_RANGES, n_cells // slices // TASK_CELLS))
    if slices > 1:
        own = F.pmod(F.xxhash64("protein_id"), F.lit(slices)) == number
        both, known = both.filter(own), None if known is None else known.filter(own)
    steps = round(1 / opt.step)
    # least() skips nulls, so rows without a score are told apart first
    reached = F.least(F.floor(F.col("score") * steps + 1e-9), F.lit(steps - 1)).cast("int")
    level = F.when(F.col("score").isNull(), -1).when(F.isnan("score"), steps).otherwise(reached).alias("level")
    sent = both.join(lists, "term").select(
        "protein_id", level, "is_true", F.lit(0).alias("known"), "n_own", "codes", "weights", "shared"
    )
    if known is not None:
        settled = known.select("protein_id", F.col("term").alias("target")).join(wanted, "target").select(
            "protein_id", F.lit(-1).alias("level"), F.lit(0).alias("is_true"), F.lit(1).alias("known"), F.lit(0).alias("n_own"),
            F.array("code").alias("codes"), F.array("ia").alias("weights"), F.lit(None).cast("int").alias("shared"),
        )
        sent = sent.unionByName(settled.filter("protein_id IS NOT NULL"))
    # the shared lists are few and small (SHARED_ENTRIES), and a join with them must leave proteins where they are
    here = sent.repartition(tasks, "protein_id").join(F.broadcast(shared), "shared", "left").sortWithinPartitions("protein_id")
    near = F.struct("n_own", "codes", "weights")
    upper = F.struct(F.lit(0).alias("n_own"), F.col("upper_codes").alias("codes"), F.col("upper_weights").alias("weights"))
    parts = F.when(F.col("upper_codes").isNull(), F.array(near)).otherwise(F.array(near, upper))
    rows = here.select("protein_id", "level", "is_true", "known", F.inline(parts))
    spaces = wanted.groupBy("namespace", "copies").agg(F.min("code").alias("first_code")).orderBy("first_code").collect()
    return Cells(rows, spaces, wanted.schema["namespace"].dataType, steps, opt.fill)


def _best_rows(table, group, bins, fill):
    """The distinct (group, code) pairs: (group, code, weight, true or known, the best of the ``bins`` of their rows, their own bin).

    Bins are numbers that grow with the group first. With ``fill`` a term that is predicted itself has the bin of that row.
    """
    level, flags = L.column(table, "level"), L.column(table, "is_true") | (L.column(table, "known") << 1)
    lens, n_own = L.lengths(table, "codes"), L.column(table, "n_own")
    codes, weights, before = L.entries(table, "codes"), L.entries(table, "weights"), np.r_[0, np.cumsum(lens)]
    out = []
    for lo, hi in L.blocks(group, lens):
        here = slice(before[lo], before[hi])
        if here.start == here.stop:
            continue
        found = codes[here].astype(np.int64)
        row, order, heads, owner = L.meet(group[lo:hi] - group[lo], lens[lo:hi], found)
        rows = row[order]
        best, own = np.maximum.reduceat(bins[lo:hi][rows], heads), None
        if fill:
            itself = (order - (before[lo:hi] - before[lo])[rows] < n_own[lo:hi][rows]) & (level[lo:hi][rows] >= 0)
            own = np.maximum.reduceat(np.where(itself, bins[lo:hi][rows], -1), heads)
        flag = np.bitwise_or.reduceat(flags[lo:hi][rows], heads)
        out.append((owner + group[lo], found[order[heads]], weights[here][order[heads]], flag, best, own))
    if not out:
        return None
    return [None if parts[0] is None else np.concatenate(parts) for parts in zip(*out, strict=True)]


def _shrunk(fill):
    """Folds the rows of one protein to its cells: a row for each level with all cells there, and one for each own score."""

    def run(table):
        level = L.column(table, "level")
        cells = _best_rows(table, np.zeros(table.num_rows, np.int64), level.astype(np.int64), fill)
        if cells is None:
            return table.slice(0, 1)
        _, codes, weights, flag, best, own = cells
        kind = (best + 1) * 4 + flag
        order = np.argsort(kind, kind="stable")
        kinds, sizes = np.unique(kind, return_counts=True)
        levels, flags, n_own = kinds // 4 - 1, kinds % 4, np.zeros(len(kinds), np.int64)
        if fill:
            one = own >= 0
            levels, flags, n_own = np.r_[levels, own[one]], np.r_[flags, flag[one]], np.r_[n_own, np.ones(one.sum(), np.int64)]
            order, sizes = np.r_[order, np.flatnonzero(one)], np.r_[sizes, np.ones(one.sum(), np.int64)]
        columns = {
            "protein_id": table.column("protein_id").combine_chunks().take(pa.array(np.zeros(len(levels), np.int64))),
            "level": levels, "is_true": flags & 1, "known": flags >> 1, "n_own": n_own,
            "codes": L.list_array(codes[order].astype(np.int32), sizes), "weights": L.list_array(weights[order], sizes),
        }
        plain = [columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name].astype(np.int32)) for f in table.schema]
        return pa.table(plain, names=table.schema.names).cast(table.schema)

    return run


def _ratios(a, b):
    return np.divide(a, b, out=np.zeros(len(a)), where=b != 0)


def _fold(spaces, namespace_type, steps, fill):
    """Per namespace and level: how the ratios and sums of the proteins of a task change there."""
    names = list(dict.fromkeys(s.namespace for s in spaces))
    first, copies = np.array([s.first_code for s in spaces], np.int64), np.array([s.copies for s in spaces], np.float64)
    spot = np.array([names.index(s.namespace) for s in spaces], np.int64)
    n_names = max(1, len(names))

    def changes(table, group, sums):
        levels = L.column(table, "level").astype(np.int64) + 1
        bins, bin_of_row = np.unique(group * (steps + 2) + levels, return_inverse=True)
        cells = _best_rows(table, group, bin_of_row, fill)
        if cells is None:
            return
        _, codes, weights, flag, best, own = cells
        if fill:
            best = np.where(own >= 0, own, best)
        if (flag & 2).any():
            left = flag < 2
            codes, weights, flag, best = codes[left], weights[left], flag[left], best[left]
        space = np.searchsorted(first, codes, "right") - 1
        many, true = copies[space], flag.astype(np.float64)
        at = best * n_names + spot[space]
        totals = [np.bincount(at, v, len(bins) * n_names) for v in (many, many * true, weights, weights * true)]
        kept = np.flatnonzero(totals[0] > 0)
        if not len(kept):
            return
        # rows per group, namespace and level, high levels first; what is not predicted or not a number is at level 0
        owner, level = np.divmod(bins[kept // n_names], steps + 2)
        level = np.where((level == 0) | (level == steps + 1), 0, level - 1)
        key = (owner * n_names + kept % n_names) * steps + (steps - 1 - level)
        key, back = np.unique(key, return_inverse=True)
        n, t, wn, wt = (np.bincount(back, v[kept], len(key)) for v in totals)
        part, level = key // steps, steps - 1 - key % steps
        starts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
        sizes = np.diff(np.r_[starts, len(part)])
        place = np.arange(len(part)) - np.repeat(starts, sizes)
        own_t, own_wt = t.copy(), wt.copy()
        by_place = np.argsort(place, kind="stable")
        for some in np.split(by_place, np.flatnonzero(np.diff(place[by_place])) + 1)[1:]:
            for v in (n, t, wn, wt):
                v[some] += v[some - 1]
        ends = np.repeat(starts + sizes - 1, sizes)
        all_t, all_wt = t[ends], wt[ends]
        values = [np.ones(len(n)), _ratios(t, n), _ratios(t, all_t), _ratios(wt, wn), _ratios(wt, all_wt), wn - wt, wt, t, n, wn]
        judged = all_t > 0  # proteins with a known answer in the namespace
        line = ((part % n_names) * steps + level)[judged]
        first_of = np.r_[0, np.flatnonzero(np.diff(group)) + 1]
        named = table.column("protein_id").combine_chunks().take(pa.array(first_of)).is_valid().to_numpy(zero_copy_only=False)
        scored = named[part // n_names][judged]
        for k, v in enumerate(values):
            change = np.where(place == 0, v, v - np.roll(v, 1))[judged]
            sums[k] += np.bincount(line[scored], change[scored], n_names * steps)
        sums[-4] += np.bincount(line, (place == 0)[judged], n_names * steps)
        sums[-3] += np.bincount(line, own_t[judged], n_names * steps)
        sums[-2] += np.bincount(line, own_wt[judged], n_names * steps)
        sums[-1] += np.bincount(line, minlength=n_names * steps)

    def run(batches):
        sums = np.zeros((len(VALUES) + 4, n_names * steps))
        for table, group in L.whole_groups(batches, "protein_id", shrink=_shrunk(fill)):
            changes(table, group, sums)
        some = np.flatnonzero(sums[-1])
        columns = [pa.array([names[k] for k in some // steps], to_arrow_type(namespace_type)), pa.array((some % steps).astype(np.int32))]
        columns += [pa.array(v[some]) for v in sums[: len(VALUES)]]
        columns += [pa.array(sums[-4][some].astype(np.int64)), pa.array(sums[-3][some].astype(np.int64)), pa.array(sums[-2][some])]
        yield pa.RecordBatch.from_arrays(columns, names=["namespace", "level", *VALUES, "n_gt", "own_t", "own_wt"])

    return run


def _changes(cells):
    """Per namespace and level of one slice: how the ratios and sums of its proteins change there."""
    # cells are dealt by protein, so all up to the sums per level happens where they are
    fields = ", ".join(f"`{c}` double" for c in VALUES)
    schema = f"namespace {cells.namespace_type.simpleString()}, level int, {fields}, n_gt bigint, own_t bigint, own_wt double"
    sums = cells.rows.mapInArrow(_fold(cells.spaces, cells.namespace_type, cells.steps, cells.fill), schema)
    return sums.groupBy("namespace", "level").agg(*[F.sum(c).alias(c) for c in (*VALUES, "n_gt", "own_t", "own_wt")])


def cafa_eval(
    pred: DataFrame,
    truth: DataFrame,
    edges: DataFrame,
    terms: DataFrame,
    toi: DataFrame | None = None,
    known: DataFrame | None = None,
    options: EvalOptions | None = None,
) -> DataFrame:
    """M-17: precision, recall, F, their weighted and micro forms, and S per (namespace, tau).

    ``terms`` has term, namespace, ia. Cells are folded to one row per (protein, level), at most
    one per threshold, so the per-protein running sums are bounded. Each protein then reports only
    how its ratios change from one of its levels to the next, and the changes are added up per
    namespace, instead of every protein being repeated for every threshold. Only those sums leave
    the task that holds a protein. Proteins come in slices one after the other, so what is on its way to
    them at a time is bounded, however many there are, or grows as the lists of what terms reach do.
    """
    opt = options or EvalOptions()
    if opt.norm not in NORMS:
        raise ValueError(f"norm must be one of {NORMS}")
    parts = []
    ship_package(pred.sparkSession)
    with cuts_dropped(pred.sparkSession) as made:
        terms = cut_lineage(terms.select("term", "namespace", "ia"))
        *sides, in_lists = _sides(pred, truth, edges, terms, toi, opt)
        slices = max(1, -(-sides[-1] // max(SLICE_CELLS, in_lists)))
        for k in range(slices):
            parts.append(cut_lineage(_changes(_cells(*sides, known, opt, slices, k))))
            made.pop()  # all else a slice reads goes with the last one
    values = [c for c in parts[0].columns if c not in ("namespace", "level", "n_gt", "own_t", "own_wt")]
    # at most a row per namespace, threshold and slice, read twice below
    sums = [F.sum(c).alias(c) for c in (*values, "n_gt", "own_t", "own_wt")]
    by_level = reduce(DataFrame.unionByName, parts).groupBy("namespace", "level").agg(*sums)
    n_levels = round(1 / opt.step) - 1
    base = by_level.groupBy("namespace").agg(
        F.sum("n_gt").cast("double").alias("n_gt"),
        F.sum("own_t").cast("double").alias("sum_t"),
        F.sum("own_wt").alias("sum_wt"),
    )
    grid = base.withColumn("level", F.explode(F.sequence(F.lit(1), F.lit(n_levels))))
    above = Window.partitionBy("namespace").orderBy(F.desc("level"))
    above = above.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = grid.join(by_level.select("namespace", "level", *values), ["namespace", "level"], "left").select(
        "namespace", "level", "n_gt", "sum_t", "sum_wt",
        *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(c) for c in values],
    )
    covered, n_gt = F.col("covered"), F.col("n_gt")
    pr_by = {"cafa": covered, "pred": covered, "gt": n_gt}[opt.norm]
    rc_by = {"cafa": n_gt, "pred": covered, "gt": n_gt}[opt.norm]
    f = lambda p, r: _ratio(2.0 * F.col(p) * F.col(r), F.col(p) + F.col(r))
    rated = at.select(
        "namespace",
        F.round(F.col("level") * opt.step, 6).alias("tau"),
        _ratio(covered, n_gt).alias("cov"),
        _ratio(F.col("pr"), pr_by).alias("pr"),
        _ratio(F.col("rc"), rc_by).alias("rc"),
        _ratio(F.col("wpr"), pr_by).alias("pr_w"),
        _ratio(F.col("wrc"), rc_by).alias("rc_w"),
        _ratio(F.col("tp"), F.col("np")).alias("pr_micro"),
        _ratio(F.col("tp"), F.col("sum_t")).alias("rc_micro"),
        _ratio(F.col("found_w"), F.col("wnp")).alias("pr_micro_w"),
        _ratio(F.col("found_w"), F.col("sum_wt")).alias("rc_micro_w"),
        _ratio(F.col("mi"), n_gt).alias("mi"),
        _ratio(F.col("sum_wt") - F.col("found_w"), n_gt).alias("ru"),
    )
    return rated.select(
        "*",
        f("pr", "rc").alias("f"),
        f("pr_w", "rc_w").alias("f_w"),
        f("pr_micro", "rc_micro").alias("f_micro"),
        f("pr_micro_w", "rc_micro_w").alias("f_micro_w"),
        F.sqrt(F.col("mi") * F.col("mi") + F.col("ru") * F.col("ru")).alias("s"),
    )


def best_scores(evaluation: DataFrame) -> DataFrame:
    """M-17: best value of each measure per namespace."""
    return evaluation.groupBy("namespace").agg(
        F.max("f").alias("f_max"),
        F.max("f_w").alias("f_w_max"),
        F.max("f_micro").alias("f_micro_max"),
        F.max("f_micro_w").alias("f_micro_w_max"),
        F.min("s").alias("s_min"),
    )


def final_score(evaluation: DataFrame) -> DataFrame:
    """M-17: mean over the three namespaces of the weighted F-max."""
    return best_scores(evaluation).agg(F.avg("f_w_max").alias("final_score"))
