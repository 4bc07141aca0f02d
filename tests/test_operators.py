import random
from datetime import date, datetime, timedelta
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from seqloom.operators import agg, dedupe, evaluate, graph, joins, lineage, lists, loadtest, metrics, naming, ordering, prep, requests, scoring
from seqloom.operators.ordering import number_rows, running_totals
from seqloom.sources import tables
from seqloom.streaming import events as E


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- ordering ----------------------------------------------------------------------------------


def test_running_totals_of_hot_and_null_groups(spark):
    rng = random.Random(1)
    data = [(i, None if i % 10 == 0 else ("hot" if i % 3 else f"k{i % 7}"), rng.randint(1, 9)) for i in range(900)]
    df = spark.createDataFrame(data, "i int, k string, v int").repartition(7)
    got = {r.i: (r.n, r.s) for r in running_totals(df, ["i"], {"n": F.lit(1), "s": F.col("v")}, ["k"]).collect()}
    seen: dict = {}
    for i, k, v in data:
        n, s = seen.get(k, (0, 0))
        seen[k] = (n + 1, s + v)
        assert got[i] == seen[k]


def test_number_rows_without_groups(spark):
    df = spark.range(500).withColumn("x", F.rand(3)).repartition(5)
    got = number_rows(df, [F.desc("id")], name="n").collect()
    assert {r.id: r.n for r in got} == {i: 500 - i for i in range(500)}


# --- dedupe ------------------------------------------------------------------------------------


def check_first_come(data, kept):
    """No two kept events share a request id or a content; every dropped one meets an earlier kept one."""
    ids = {p: (("r", r), ("c", protein, digest)) for p, r, protein, digest in data}
    owner = {}
    for p in kept:
        for end in ids[p]:
            assert end not in owner
            owner[end] = p
    assert all(any(owner.get(end, p) < p for end in ids[p]) for p in ids.keys() - kept)


def test_dedupe_golden(spark):
    data = [(0, "r1", "p", "k1"), (1, "r1", "p", "k2"), (2, "r2", "p", "k2"), (3, "r3", "p", "k2")]
    df = spark.createDataFrame(data, "position int, request_id string, protein_id string, checksum string")
    assert {r.position for r in dedupe.dedupe_events(df, ["position"]).collect()} == {0, 2}
    assert {r.request_id for r in dedupe.mark_duplicates(df, ["position"]).collect()} == {"r1", "r3"}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_dedupe_is_first_come(spark, seed):
    rng = random.Random(seed)
    # a third of all events share one request id, another third one content
    data = []
    for i in range(400):
        kind = i % 3
        request = "hot" if kind == 0 else f"r{rng.randint(0, 60)}"
        content = "hot" if kind == 1 else f"c{rng.randint(0, 60)}"
        data.append((i, request if i % 50 else None, f"p{rng.randint(0, 1)}", content if i % 70 else None))
    df = spark.createDataFrame(data, "position int, request_id string, protein_id string, checksum string").repartition(5)
    check_first_come(data, {r.position for r in dedupe.dedupe_events(df, ["position"]).collect()})


def test_dedupe_alternating_chain(spark):
    data = [(i, f"r{(i + 1) // 2}", "p", f"c{i // 2}") for i in range(24)]
    df = spark.createDataFrame(data, "position int, request_id string, protein_id string, checksum string")
    kept = {r.position for r in dedupe.dedupe_events(df, ["position"]).collect()}
    assert kept == set(range(0, 24, 2))
    check_first_come(data, kept)


def test_dedupe_of_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """Ten thousand events that each block the next, dealt in any order to tasks."""
    cuts = []
    monkeypatch.setattr(dedupe, "cut_lineage", lambda df, cut=dedupe.cut_lineage: cuts.append(1) or cut(df))
    rows = [(f"r{(i + 1) // 2}", "p", f"c{i // 2}", i) for i in range(10_000)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "request_id string, protein_id string, checksum string, position int")
    kept = sorted(r.position for r in dedupe.dedupe_events(df, ["position"]).collect())
    assert kept == list(range(0, 10_000, 2))
    assert len(cuts) < 30  # two for each of a few plain rounds, one for each of 14 doublings


def test_sample_of_latencies_does_not_depend_on_tasks(spark):
    df = spark.range(5000).selectExpr("id", "CAST(id % 977 AS bigint) AS latency_ms")
    one = loadtest.sampled_latency(df.coalesce(1), "id", size=300).first()
    assert one == loadtest.sampled_latency(df.repartition(7), "id", size=300).first() and one.seen == 5000
    assert abs(one.p50_est - 488) < 100
    assert loadtest.sampled_latency(df.filter("false"), "id").first().seen == 0


def test_dedupe_with_two_part_order(spark):
    data = [(1, 0, "a", "p", "x"), (0, 5, "a", "p", "y"), (0, 6, "b", "p", "x")]
    df = spark.createDataFrame(data, "part int, position int, request_id string, protein_id string, checksum string")
    kept = dedupe.dedupe_events(df, ["part", "position"])
    assert rows(kept.select("part", "position")) == [(0, 5), (0, 6)]


# --- naming ------------------------------------------------------------------------------------


def test_unique_ids(spark):
    """Names are distinct; each is its id, or the lowest number after it that no earlier row took."""
    rng = random.Random(5)
    pool = ["a", "a", "a", "a_2", "a_3", "a_2_2", "b", "b_1", "c", None, "protein_7", ""]
    ids = [rng.choice(pool) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(ids)), "position long, protein_id string").repartition(4)
    got = [r.protein_id for r in sorted(naming.unique_ids(df, "position").collect(), key=lambda r: r.position)]
    assert len(set(got)) == len(got) == len(ids)
    for i, name in enumerate(got):
        base = ids[i] or f"protein_{i + 1}"
        number = 1 if name == base else int(name.removeprefix(f"{base}_"))
        lower = [base] + [f"{base}_{k}" for k in range(2, number)]
        assert set(lower[: number - (number == 1)]) <= set(got[:i])


# --- graph -------------------------------------------------------------------------------------


def small_graph(spark):
    edges = spark.createDataFrame([("C", "B"), ("B", "A"), ("D", "A")], "child string, parent string")
    terms = spark.createDataFrame([("A",), ("C",)], "term string")
    return edges, terms


def test_graph_golden(spark):
    edges, chosen = small_graph(spark)
    closure = graph.ancestors(edges)
    assert rows(closure) == [("B", "A"), ("C", "A"), ("C", "B"), ("D", "A")]
    ann = spark.createDataFrame([("p", "C")], "protein_id string, term string")
    assert rows(graph.propagate_labels(ann, closure, chosen)) == [("p", "A"), ("p", "C")]
    scores = spark.createDataFrame([("p", "C", 0.9), ("p", "A", 0.2)], "protein_id string, term string, score double")
    assert rows(graph.propagate_scores(scores, graph.score_paths(edges, chosen))) == [("p", "A", 0.2), ("p", "C", 0.9)]


def random_dag(rng, n):
    return sorted({(c, rng.randrange(c)) for c in range(1, n) for _ in range(2)})


def test_closure_and_no_violations_after_propagation(spark):
    rng = random.Random(9)
    pairs = random_dag(rng, 40)
    up: dict = {t: set() for t in range(40)}
    for t in range(40):
        for c, p in pairs:
            if c == t:
                up[t] |= {p} | up[p]
    edges = spark.createDataFrame(pairs, "child int, parent int")
    assert rows(graph.ancestors(edges)) == sorted((t, a) for t in up for a in up[t])
    data = [(p, t, rng.random()) for p in range(12) for t in range(40) if rng.random() < 0.3]
    scores = spark.createDataFrame(data, "protein_id int, term int, score double")
    terms = spark.range(40).select(F.col("id").cast("int").alias("term"))
    lifted = graph.propagate_scores(scores, graph.score_paths(edges, terms))
    proteins = scores.select("protein_id").distinct()
    assert graph.hierarchy_violations(scores, edges, proteins).first().violations > 0
    assert graph.hierarchy_violations(lifted, edges, proteins).first().violations == 0


def test_cycle_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(graph, "MAX_DOUBLINGS", 3)
    with pytest.raises(ValueError, match="cycle"):
        graph.ancestors(spark.createDataFrame([("a", "b"), ("b", "a")], "child string, parent string"))


def test_fill_keeps_own_scores(spark):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t,) for t in "ABCD"], "term string")
    scores = spark.createDataFrame([("p", "C", 0.9), ("p", "A", 0.2)], "protein_id string, term string, score double")
    got = rows(graph.fill_scores(scores, graph.score_paths(edges, terms)))
    assert got == [("p", "A", 0.2), ("p", "B", 0.9), ("p", "C", 0.9)]


# --- aggregates --------------------------------------------------------------------------------


def test_quantiles_and_ranks_match_numpy(spark):
    rng = random.Random(2)
    data = [("a" if i % 3 else "b", rng.randint(0, 30)) for i in range(301)]
    df = spark.createDataFrame(data, "g string, v int")
    got = {r.g: r for r in agg.describe(df, "v", ["g"]).collect()}
    near = {r.g: r.p95 for r in agg.nearest_ranks(df, "v", {"p95": 0.95}, ["g"]).collect()}
    for g in "ab":
        v = np.array(sorted(x for k, x in data if k == g))
        assert np.allclose([got[g].p25, got[g].p50, got[g].p75, got[g]["std"]], [*np.quantile(v, [0.25, 0.5, 0.75]), v.std(ddof=1)])
        assert near[g] == v[min(len(v) - 1, round((len(v) - 1) * 0.95))]


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 5)], "g string, v int")
    assert {r.g: r.p50 for r in agg.describe(df, "v", ["g"]).collect()} == {None: 2.0, "a": 5.0}
    chunks = scoring.with_chunk_totals(scoring.chunk(df, 2, ["v"], ["g"]), ["g"]).collect()
    assert sorted((str(r.g), r.chunk_size, r.total_chunks) for r in chunks) == [("None", 2, 1), ("None", 2, 1), ("a", 1, 1)]


def test_histograms_match_numpy(spark):
    values = [float(x) for x in (0, 1, 1, 2, 5, 9, 10, 10)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r.n for r in agg.histogram(df, "v", 4).orderBy("bin").collect()] == np.histogram(values, 4)[0].tolist()
    edges = [0, 1, 5, 10]
    assert [r.n for r in agg.histogram_edges(df, "v", edges).orderBy("bin").collect()] == np.histogram(values, edges)[0].tolist()
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r.n for r in agg.histogram(flat, "v", 4).orderBy("bin").collect()] == np.histogram([3.0, 3.0], 4)[0].tolist()


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("u", "z"), ("u", "z"), ("u", "a")], "k string, c string")
    assert rows(agg.mode_by(df, "k", "c")) == [("t", "a"), ("u", "z")]


def test_latency_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(0,), (None,)], "latency_ms int")
    assert tuple(requests.latency_stats(df).first()) == (0, 0)


def test_throughput_is_zero_filled(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 7, 59),), (datetime(2024, 1, 1, 0, 8, 0),)], "created_at timestamp")
    got = requests.throughput(df, datetime(2024, 1, 1, 0, 8, 30)).orderBy("window_start").collect()
    assert [r.metric_value for r in got] == [0] * 6 + [1, 1]


def test_approximate_percentiles_are_close(spark):
    df = spark.range(1, 20001).select(F.col("id").alias("latency_ms"))
    row = loadtest.approx_latency(df).first()
    assert abs(row.p95_est - 19000) <= 40 and abs(row.p50_est - 10000) <= 40


def test_bench_checkpoints_across_tasks(spark):
    data = [(i, 2, None if i % 4 else "x", i * 0.1) for i in range(1, 96)]
    df = spark.createDataFrame(data, "seq long, record_count int, error string, elapsed_seconds double")
    got = loadtest.bench_checkpoints(df, 20).orderBy("completed_requests").collect()
    assert [(r.completed_requests, r.completed_sequences, r.failure_count) for r in got] == [(n, 2 * n, n // 4) for n in (20, 40, 60, 80)]


def test_scale_up_cycles(spark):
    base = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, protein_id string")
    got = [r.protein_id for r in loadtest.scale_up(base, 8, ["pos"]).orderBy("sequence_index").collect()]
    assert got == ["a", "b", "c", "a__r2", "b__r2", "c__r2", "a__r3", "b__r3"]


# --- preparation -------------------------------------------------------------------------------


def test_split_is_disjoint_complete_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").alias("protein_id"), F.when(F.col("id") < 900, "hot").otherwise("cold").alias("stratum"))
    one, many = prep.split(df), prep.split(df.repartition(9))
    assert prep.verify_split(one, many).count() == 0
    assert joins.overlapping_ids(one).count() == 0 and one.count() == 1000
    sizes = {(r.stratum, r.split): r["count"] for r in one.groupBy("stratum", "split").count().collect()}
    assert sizes == {("hot", "test"): 135, ("hot", "valid"): 135, ("hot", "train"): 630, ("cold", "test"): 15, ("cold", "valid"): 15, ("cold", "train"): 70}


def test_weights(spark):
    df = spark.createDataFrame([(1.0,), (4.0,), (float("nan"),), (None,)], "ia double")
    raised = np.array([1.0, 2.0, 1.0, 1.0])
    got = [r.ia_loss_weight for r in prep.ia_weight(df).collect()]
    assert np.allclose(got, np.clip(raised / raised.mean(), 0.25, 8.0))


def test_ensemble_weights():
    assert scoring.normalized_weights({"a": 1.0, "b": 3.0}, ["a", "b"]) == {"a": 0.25, "b": 0.75}
    assert scoring.normalized_weights({}, ["a", "b"]) == {"a": 0.5, "b": 0.5}


def test_broken_scoring_batch_becomes_error_rows(spark):
    def model(frame):
        if (frame["protein_id"] == "p3").any():
            raise RuntimeError("boom")
        return frame.assign(score=1.0)

    df = spark.createDataFrame([(f"p{i}",) for i in range(8)], "protein_id string").coalesce(1)
    got = {r.protein_id: r for r in scoring.score(df, model, "protein_id string, score double", batch=4).collect()}
    assert [got[f"p{i}"].error_code for i in range(8)] == ["RuntimeError"] * 4 + [None] * 4
    assert got["p7"].score == 1.0 and got["p0"].error_message == "boom"


# --- metrics -----------------------------------------------------------------------------------


def dense_case(spark, seed=4, n=12, m=9):
    rng = np.random.default_rng(seed)
    y, s = (rng.random((n, m)) < 0.3).astype(int), np.where(rng.random((n, m)) < 0.7, rng.integers(1, 20, (n, m)) / 20, 0.0)
    truth = spark.createDataFrame([(i, j) for i in range(n) for j in range(m) if y[i, j]], "protein_id int, term int")
    scores = spark.createDataFrame([(i, j, float(s[i, j])) for i in range(n) for j in range(m) if s[i, j] > 0], "protein_id int, term int, score double")
    proteins = spark.range(n).select(F.col("id").cast("int").alias("protein_id"))
    terms = spark.range(m).select(F.col("id").cast("int").alias("term"))
    return y, s, truth, scores, proteins, terms


def test_metrics_match_the_dense_definition(spark):
    y, s, truth, scores, proteins, terms = dense_case(spark)
    grid = [0.2, 0.5, 0.8]
    got = {r.threshold: r for r in metrics.tune(metrics.pair_table(truth, scores), grid, proteins, terms).collect()}
    for t in grid:
        p = (s >= t).astype(int)
        tp, fp, fn = (y * p).sum(0), ((1 - y) * p).sum(0), (y * (1 - p)).sum(0)
        f1 = np.where(2 * tp + fp + fn > 0, 2 * tp / np.maximum(2 * tp + fp + fn, 1), 0)
        assert np.isclose(got[t].macro_f1, f1.mean())
        assert np.isclose(got[t].micro_f1, 2 * tp.sum() / (2 * tp.sum() + fp.sum() + fn.sum()))
        assert np.isclose(got[t].avg_pred_terms, p.sum(1).mean())
    assert sum(r.is_best for r in got.values()) == 1


def test_rounds_of_the_closure_write_a_row_per_term(spark, monkeypatch):
    n = 24  # a ladder: every term has the next two as parents
    pairs = [(t, p) for t in range(n) for p in (t + 1, t + 2) if p < n]
    written = []

    def cut(df):
        written.append(lineage.cut_lineage(df))
        return written[-1]

    monkeypatch.setattr(graph, "cut_lineage", cut)
    edges = spark.createDataFrame([*pairs, (0, None)], "child int, parent int")
    got = {tuple(r) for r in graph.ancestors(edges).collect()}
    assert got == {(t, a) for t in range(n) for a in range(t + 1, n)} | {(0, None)}
    assert max(df.count() for df in written) <= n


def test_cells_of_an_evaluation_stay_with_their_protein(spark):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 1.0) for t in "ABCD"], "term string, namespace string, ia double")
    truth = spark.createDataFrame([("p", "C")], "protein_id string, term string")
    pred = spark.createDataFrame([("p", "C", 0.9), ("p", "D", 0.5)], "protein_id string, term string, score double")
    known = truth.filter("term = 'B'")
    cells = evaluate._prepare(pred, truth, edges, terms, None, known, evaluate.EvalOptions())
    plan = cells.groupBy("namespace", "protein_id", "level").count()._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Exchange" not in plan[: plan.index("Generate")] and "Join" not in plan[: plan.index("Generate")]


def test_cafa_eval_matches_a_dense_pass(spark):
    rng = np.random.default_rng(8)
    m, n, step = 10, 14, 0.1
    pairs = random_dag(random.Random(3), m)
    up = {t: {t} for t in range(m)}
    for t in range(m):
        for c, p in pairs:
            if c == t:
                up[t] |= up[p]
    y0 = rng.random((n, m)) < 0.12
    s0 = np.where(rng.random((n, m)) < 0.4, rng.integers(1, 10, (n, m)) / 10, 0.0)
    ia = rng.random(m) + 0.1
    y, s = np.zeros((n, m), bool), np.zeros((n, m))
    for t in range(m):
        for a in up[t]:
            y[:, a] |= y0[:, t]
            s[:, a] = np.maximum(s[:, a], s0[:, t])
    space = np.array([t % 2 for t in range(m)])
    truth = spark.createDataFrame([(i, j) for i in range(n) for j in range(m) if y0[i, j]], "protein_id int, term int")
    pred = spark.createDataFrame([(i, j, float(s0[i, j])) for i in range(n) for j in range(m) if s0[i, j] > 0], "protein_id int, term int, score double")
    edges = spark.createDataFrame(pairs, "child int, parent int")
    terms = spark.createDataFrame([(t, f"ns{space[t]}", float(ia[t])) for t in range(m)], "term int, namespace string, ia double")
    for norm in evaluate.NORMS:
        out = evaluate.cafa_eval(pred, truth, edges, terms, options=evaluate.EvalOptions(step=step, norm=norm))
        got = {(r.namespace, round(r.tau, 6)): r for r in out.collect()}
        for ns in (0, 1):
            cols = space == ns
            judged = y[:, cols].any(1)
            yy, ss, w = y[judged][:, cols], s[judged][:, cols], ia[cols]
            for k in range(1, 10):
                p = ss >= k * step - 1e-9
                cov = p.any(1)
                with np.errstate(all="ignore"):
                    pr = np.nan_to_num((p & yy).sum(1) / p.sum(1))
                    wpr = np.nan_to_num(((p & yy) * w).sum(1) / (p * w).sum(1))
                rc, wrc = (p & yy).sum(1) / yy.sum(1), ((p & yy) * w).sum(1) / (yy * w).sum(1)
                a = {"cafa": cov.sum(), "pred": cov.sum(), "gt": len(yy)}[norm]
                b = {"cafa": len(yy), "pred": cov.sum(), "gt": len(yy)}[norm]
                r = got[(f"ns{ns}", round(k * step, 6))]
                want_pr, want_rc = (pr.sum() / a if a else 0), (rc.sum() / b if b else 0)
                want_w = (wpr.sum() / a if a else 0), (wrc.sum() / b if b else 0)
                f = lambda x, z: 2 * x * z / (x + z) if x + z else 0
                mi, ru = ((p & ~yy) * w).sum(1).mean(), ((~p & yy) * w).sum(1).mean()
                got_row = [r.pr, r.rc, r.f, r.f_w, r.s]
                assert np.allclose(got_row, [want_pr, want_rc, f(want_pr, want_rc), f(*want_w), np.hypot(mi, ru)]), (norm, ns, k)


def test_eval_options(spark):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 1.0) for t in "ABCD"], "term string, namespace string, ia double")
    truth = spark.createDataFrame([("p", "C")], "protein_id string, term string")
    pred = spark.createDataFrame([("p", "C", 0.9), ("p", "D", 0.5)], "protein_id string, term string, score double")
    run = lambda **k: {r.tau: r for r in evaluate.cafa_eval(pred, truth, edges, terms, **k).collect()}
    opt = evaluate.EvalOptions
    assert run(options=opt(step=0.1))[0.5].pr == pytest.approx(3 / 4)
    assert run(options=opt(step=0.1, max_terms=1))[0.5].pr == 1.0
    assert run(options=opt(step=0.1, no_orphans=True))[0.5].pr == pytest.approx(2 / 3)
    known = spark.createDataFrame([("p", "B"), ("p", "A")], "protein_id string, term string")
    assert run(options=opt(step=0.1), known=known)[0.5].pr == pytest.approx(1 / 2)
    toi = spark.createDataFrame([("C",)], "term string")
    assert run(options=opt(step=0.1), toi=toi)[0.5].pr == 1.0
    assert run(options=opt(step=0.1, fill=True))[0.9].rc == 1.0


def test_evaluation_in_slices_leaves_no_shuffles(spark, monkeypatch):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 0.5 + k) for k, t in enumerate("ABCD")], "term string, namespace string, ia double")
    truth = spark.createDataFrame([(f"p{i}", "BCD"[i % 3]) for i in range(20)], "protein_id string, term string")
    pred = spark.createDataFrame([(f"p{i}", t, (i % 7 + k) / 10) for i in range(25) for k, t in enumerate("ABCD")], "protein_id string, term string, score double")
    known = truth.filter("protein_id < 'p14'")
    run = lambda: sorted(evaluate.cafa_eval(pred, truth, edges, terms, None, known, evaluate.EvalOptions(step=0.1)).collect())
    cuts, whole = [], run()
    inner = evaluate._changes
    monkeypatch.setattr(evaluate, "_changes", lambda cells: cuts.append(cells) or inner(cells))
    monkeypatch.setattr(evaluate, "SLICE_CELLS", 80)
    sliced = run()
    assert len(cuts) > 1 and len(sliced) == len(whole) > 0
    for a, b in zip(whole, sliced, strict=True):
        assert a.namespace == b.namespace and list(a)[1:] == pytest.approx(list(b)[1:])


def test_an_evaluation_drops_what_it_cut(spark, monkeypatch):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 0.5 + k) for k, t in enumerate("ABCD")], "term string, namespace string, ia double")
    truth = spark.createDataFrame([(f"p{i}", "BCD"[i % 3]) for i in range(20)], "protein_id string, term string")
    pred = spark.createDataFrame([(f"p{i}", t, (i % 7 + k) / 10) for i in range(25) for k, t in enumerate("ABCD")], "protein_id string, term string, score double")
    run = lambda: evaluate.cafa_eval(pred, truth, edges, terms, options=evaluate.EvalOptions(step=0.1))
    whole = sorted(run().collect())
    sums, inner = [], evaluate._changes
    monkeypatch.setattr(evaluate, "_changes", lambda cells: sums.append(1) or inner(cells))
    monkeypatch.setattr(evaluate, "SLICE_CELLS", 80)
    monkeypatch.setattr(evaluate, "PIECE_PAIRS", 2)
    monkeypatch.setattr(evaluate, "PIECE_PAIRS_A_TERM", 0)
    with lineage.cuts_dropped(spark) as made:
        found = run()
        left = [path for path in made if Path(path).exists()]
        sliced = sorted(found.collect())
    assert len(left) == len(sums) > 1  # the sums of the slices
    for a, b in zip(whole, sliced, strict=True):
        assert a.namespace == b.namespace and list(a)[1:] == pytest.approx(list(b)[1:])


def test_terms_of_an_evaluation_are_numbered_in_few_ranges(spark, monkeypatch):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 1.0) for t in "ABCD"], "term string, namespace string, ia double")
    ranges, inner = [], ordering._ranges
    monkeypatch.setattr(ordering, "_ranges", lambda df: ranges.append(inner(df)) or ranges[-1])
    wanted = evaluate._folded_terms(terms.join(terms.select("term"), "term"), edges, None, evaluate.EvalOptions(no_orphans=True))
    assert {r.code: r.target for r in wanted.collect()} == {1: "B", 2: "C", 3: "D"}
    assert ranges == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_common_targets_are_sent_by_number(spark, monkeypatch):
    pairs = [(f"t{i:02}", "m0") for i in range(40)] + [(f"m{k}", f"m{k + 1}") for k in range(3)]
    edges = spark.createDataFrame(pairs, "child string, parent string")
    terms = spark.createDataFrame([(t, "ns", 0.5 + k / 10) for k, t in enumerate(sorted({x for p in pairs for x in p}))], "term string, namespace string, ia double")
    monkeypatch.setattr(evaluate, "SHARED_TARGETS", 4)
    wanted = evaluate._folded_terms(terms, edges, None, evaluate.EvalOptions())
    lists, shared = evaluate._target_lists(wanted, terms, edges)
    leaves = lists.filter("term LIKE 't%'").join(shared, "shared").collect()
    weight = {r.code: r.ia for r in wanted.collect()}
    names = {r.code: r.target for r in wanted.collect()}
    assert len(leaves) == 40 and {len(r.codes) for r in leaves} == {1} and {r.cells for r in leaves} == {5}
    for r in leaves:
        assert {names[c] for c in r.codes + r.upper_codes} == {r.term, *[f"m{k}" for k in range(4)]}
        assert [weight[c] for c in r.codes + r.upper_codes] == r.weights + r.upper_weights
    truth = spark.createDataFrame([(i, f"t{i % 40:02}") for i in range(50)], "protein_id int, term string")
    pred = spark.createDataFrame([(i, f"t{(i * k) % 40:02}", k / 5) for i in range(50) for k in (1, 2, 3)], "protein_id int, term string, score double")
    run = lambda: sorted(evaluate.cafa_eval(pred, truth, edges, terms, options=evaluate.EvalOptions(step=0.1, fill=True)).collect())
    by_number = run()
    monkeypatch.setattr(evaluate, "SHARED_ENTRIES", 0)
    for a, b in zip(by_number, run(), strict=True):
        assert a.namespace == b.namespace and list(a)[1:] == pytest.approx(list(b)[1:])


def test_closure_as_lists_in_pieces(spark, monkeypatch):
    pairs = [(c + 1, p + 1) for c, p in random_dag(random.Random(5), 30)]
    edges = spark.createDataFrame([(c, p, p / 2) for c, p in pairs], "child int, parent int, weight double")
    want = rows(graph.ancestors(edges.select("child", "parent")))
    got = graph.ancestor_lists(edges, 1, 3).collect()
    assert sorted((r.node, a) for r in got for a in r.codes) == want and len({r.node for r in got}) == len(got)
    assert all(r.codes == sorted(r.codes) and r.weights == [a / 2 for a in r.codes] for r in got)
    monkeypatch.setattr(graph, "MAX_DOUBLINGS", 2)
    loop = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "child int, parent int, weight double")
    with pytest.raises(ValueError, match="cycle"):
        graph.ancestor_lists(loop, 1, 3)


def test_an_evaluation_broadcasts_no_terms(spark):
    edges, _ = small_graph(spark)
    terms = spark.createDataFrame([(t, "ns", 1.0) for t in "ABCD"], "term string, namespace string, ia double")
    plans, cut = [], evaluate.cut_lineage
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(evaluate, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
        evaluate._folded_terms(terms, edges, terms.filter("term <> 'D'"), evaluate.EvalOptions(no_orphans=True))
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]
    ia = joins.with_ia(terms.select("term"), terms.hint("merge"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in ia


@pytest.mark.parametrize("fill", [False, True])
def test_cells_fold_alike_in_batches_of_any_size(spark, monkeypatch, fill):
    rng = random.Random(11)
    data = []
    for protein in [None, *range(12)]:
        for _ in range(rng.randint(1, 9)):
            codes = sorted(rng.sample(range(1, 41), rng.randint(0, 12)))
            level = rng.randint(-1, 10)
            data.append((protein, level, int(rng.random() < 0.4), int(rng.random() < 0.1), int(bool(codes) and rng.random() < 0.5), codes, [c / 7 for c in codes]))
    schema = pa.schema([("protein_id", pa.int64()), *[(c, pa.int32()) for c in ("level", "is_true", "known", "n_own")], ("codes", pa.list_(pa.int32())), ("weights", pa.list_(pa.float64()))])
    batch = pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*data, strict=True), schema, strict=True)], schema=schema)
    spaces = [Row(namespace="a", copies=1, first_code=1), Row(namespace="a", copies=2, first_code=15), Row(namespace=None, copies=1, first_code=30)]
    fold = evaluate._fold(spaces, StringType(), 10, fill)
    sums = lambda batches: [[round(v, 9) if isinstance(v, float) else v for v in r.values()] for b in fold(batches) for r in b.to_pylist()]
    whole = sums([batch])
    # by hand: the sums of known answers per namespace, each distinct cell once for each copy of its term
    true: dict = {}
    for protein, _, is_true, known, _, codes, _ in data:
        for c in codes:
            was = true.get((protein, c), (0, 0))
            true[protein, c] = (max(was[0], is_true), max(was[1], known))
    count = lambda cs: sum((2 if 15 <= c < 30 else 1) for (_, c), (t, k) in true.items() if t and not k and c in cs)
    for name, codes in (("a", range(1, 30)), (None, range(30, 41))):
        assert sum(r[-2] for r in whole if r[0] == name) == count(codes) > 0
    monkeypatch.setattr(lists, "BLOCK_ENTRIES", 16)
    for most in (1 << 24, 30):
        monkeypatch.setattr(lists, "MOST_HELD", most)
        assert sums([batch.slice(i, 2) for i in range(0, len(data), 2)]) == whole


def test_a_cut_frees_what_it_shuffled(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = blocks.getAllFiles().size()
    cut = lineage.cut_lineage(spark.range(1000).withColumn("k", F.rand(1)).repartition(7, "k"))
    assert blocks.getAllFiles().size() <= before
    assert cut.count() == 1000


# --- tables ------------------------------------------------------------------------------------


def test_upsert_lets_nulls_overwrite(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "k string, ts int, v string")
    new = spark.createDataFrame([("a", 2, None), ("a", 1, "z"), ("c", 1, "w")], "k string, ts int, v string")
    assert {(r.k, r.v) for r in tables.upsert(old, new, ["k"], ["ts"]).collect()} == {("a", None), ("b", "y"), ("c", "w")}


def test_apply_upsert_rewrites_touched_partitions_only(spark, tmp_path):
    path = str(tmp_path / "t")
    schema = "day string, k string, v int"
    spark.createDataFrame([("d1", "a", 1), ("d2", "b", 1)], schema).write.partitionBy("day").parquet(path)
    before = sorted(p.name for p in (tmp_path / "t" / "day=d2").iterdir() if p.suffix == ".parquet")
    tables.apply_upsert(spark, path, spark.createDataFrame([("d1", "a", 2), ("d1", "c", 3)], schema), ["day", "k"], ["v"], "day")
    assert sorted((r.day, r.k, r.v) for r in spark.read.parquet(path).collect()) == [("d1", "a", 2), ("d1", "c", 3), ("d2", "b", 1)]
    assert sorted(p.name for p in (tmp_path / "t" / "day=d2").iterdir() if p.suffix == ".parquet") == before


def test_first_source_prefers_the_first_with_rows(spark):
    a = spark.createDataFrame([("k1", 1)], "k string, v int")
    b = spark.createDataFrame([("k1", 2), ("k2", 3), ("k2", 4)], "k string, v int")
    got = joins.first_source([a, b], ["k"])
    assert rows(got.select("k", "v")) == [("k1", 1), ("k2", 3), ("k2", 4)]


def test_request_progress(spark):
    schema = (
        "request_id string, seq int, event_type string, modal_event string, modal_step string, current_status string, "
        "total_chunks int, chunk_index int, total_batches int, batch_index int"
    )
    s = "request_status"
    data = [
        ("one", 1, s, "start", None, None, None, None, None, None),
        ("two", 1, s, "batch", None, None, None, None, 4, 0), ("two", 2, s, "batch", None, None, None, None, 4, 1),
        ("chunks", 1, s, "batch", None, None, 2, 0, 2, 0), ("chunks", 2, s, "chunk_done", None, None, 2, 1, 2, 0),
        ("done", 1, s, "done", None, None, None, None, None, None),
        ("result", 1, "prediction_result", None, None, "Completed", None, None, None, None),
    ]
    got = {r.request_id: r.percent for r in requests.request_progress(spark.createDataFrame(data, schema)).collect()}
    assert got == {"one": 25.0, "two": 75.0, "chunks": 87.5, "done": 100.0, "result": 100.0}


def test_analysis_falls_back_to_all_rows(spark):
    wanted = spark.createDataFrame([(1, "p"), (1, "q")], "batch_id int, protein_id string")
    found = spark.createDataFrame([(1, "p", "a", 0.2), (1, "x", "b", 0.9)], "batch_id int, protein_id string, term string, score double")
    got = E.analysis_from_batch(wanted, found, 1)
    assert rows(got.select("protein_id", "term")) == [("p", "a"), ("q", "b")]


# --- names, windows and pages without lists ----------------------------------------------------


def first_come_names(ids):
    taken, out = set(), []
    for i, given in enumerate(ids):
        base = given or f"protein_{i + 1}"
        name, k = base, 2
        while name in taken:
            name, k = f"{base}_{k}", k + 1
        taken.add(name)
        out.append(name)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_unique_ids_against_first_come(spark, seed):
    rng = random.Random(seed)
    pool = ["a"] * 6 + [f"a_{k}" for k in range(1, 9)] + ["a_2_2", "a_2_3", "a_2_2_2", "a_02", "b_2", "b", "b", "_2", None, "protein_9"]
    ids = [rng.choice(pool) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(ids)), "position long, protein_id string").repartition(4)
    got = [r.protein_id for r in sorted(naming.unique_ids(df, "position").collect(), key=lambda r: r.position)]
    assert got == first_come_names(ids)


def test_unique_ids_pass_many_taken_numbers_in_few_rounds(spark, monkeypatch):
    cuts = []
    monkeypatch.setattr(naming, "cut_lineage", lambda df, cut=naming.cut_lineage: cuts.append(1) or cut(df))
    ids = ["a"] + [f"a_{k}" for k in range(2, 10_002)] + ["a"] * 5_000 + ["a_10002"]
    df = spark.createDataFrame(list(enumerate(ids)), "position long, protein_id string")
    got = [r.protein_id for r in sorted(naming.unique_ids(df, "position").collect(), key=lambda r: r.position)]
    assert got[-1] == "a_10002_2" and got[10_001] == "a_10002" and got[15_000] == "a_15001"
    assert len(set(got)) == len(ids) and len(cuts) < 20


def test_windows_of_any_length(spark):
    rng = random.Random(4)
    start = datetime(2024, 1, 1)
    at = lambda s: start + timedelta(seconds=s)
    times = [rng.uniform(0, 5000) for _ in range(300)] + [100.0] * 50 + [None]
    windows = [(i, s, s + rng.choice([0, 1, 30, 4000])) for i, s in enumerate(rng.uniform(-100, 5000) for _ in range(80))]
    windows += [(900, 100.0, 101.0), (901, 99.0, 100.0), (902, 50.0, 20.0), (903, None, 20.0), (900, 100.0, 101.0)]
    when = lambda s: None if s is None else at(s)
    df = spark.createDataFrame([(i, when(t)) for i, t in enumerate(times)], "id int, created_at timestamp")
    wins = spark.createDataFrame([(i, when(a), when(b)) for i, a, b in windows], "w int, window_start timestamp, window_end timestamp")
    hits = lambda a, b: [i for i, t in enumerate(times) if None not in (t, a, b) and when(a) <= when(t) < when(b)]
    assert rows(joins.count_in_windows(df, wins).select("w", "metric_value")) == sorted((w, len(hits(a, b))) for w, a, b in windows)
    want = sorted((w, i) for w, a, b in windows for i in hits(a, b))
    assert rows(joins.rows_in_windows(df, wins).select("w", "id")) == want
    assert joins.rows_in_windows(df, wins.filter("false")).isEmpty() and joins.count_in_windows(df.filter("false"), wins).count() == len(windows)


def test_rows_meet_windows_in_sorted_bins(spark):
    start = datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, start + timedelta(seconds=i)) for i in range(100)], "id int, created_at timestamp")
    wins = df.select(F.col("id"), F.col("created_at").alias("window_start"), (F.col("created_at") + F.expr("INTERVAL 8 SECONDS")).alias("window_end"))
    met = joins.rows_in_windows(df, wins)
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert met.columns == ["id", "created_at", "id", "window_start", "window_end"] and met.count() == 8 * 100 - 28
    assert {(r[2], r[0]) for r in met.collect()} == {(w, i) for w in range(100) for i in range(w, min(100, w + 8))}


def test_pages_by_seek_walk_the_whole_order(spark, tmp_path):
    rng = random.Random(2)
    data = [(i, rng.choice([None, 1, 2, 3]), rng.choice(["x", None]), i) for i in range(60)]
    spark.createDataFrame(data, "id int, a int, b string, c int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    order = [("a", True), ("b", False), ("c", True)]
    whole = [r.id for r in df.orderBy(F.desc("a"), F.asc("b"), F.desc("c")).collect()]
    seen, last, more = [], None, True
    while more:
        got = requests.page_after(df, 7, order, last).collect()
        seen += [r.id for r in got]
        more, last = got[-1].has_next, (got[-1].a, got[-1].b, got[-1].c)
    assert seen == whole
    assert "PushedFilters: [Or(" in requests.page_after(df, 7, order, (2, "x", 5))._jdf.queryExecution().toString()
    assert [r.id for r in requests.page(df, 3, 7, [F.desc("a"), F.asc("b"), F.desc("c")]).collect()] == whole[14:21]


def test_links_and_results_without_lists(spark):
    events = spark.createDataFrame([("r1", "p1", 5), ("r2", " p2 ", 6), ("r3", " ", 7)], "request_id string, protein_id string, sequence_length int")
    records = spark.createDataFrame([("r1", " q ", 1), ("r1", "", 2), ("r9", "z", 3)], "request_id string, protein_id string, sequence_length int")
    assert rows(joins.link_records(events, records)) == [("r1", "q", 1), ("r2", "p2", 6)]
    kind = "protein_id string, model string, go_term string, score double, aspect string, name string, rank int"
    predictions = spark.createDataFrame([("p1", "m", "t1", 0.5, None, None, 2), ("p1", "m", "t2", 0.7, None, None, 1)], kind)
    got = joins.attach_results(events, predictions).select("request_id", "go_term", "score")
    assert sorted(map(tuple, got.collect()), key=str) == [("r1", "t1", 0.5), ("r1", "t2", 0.7), ("r2", None, 0.0), ("r3", None, 0.0)]
    short = joins.attach_summary(events, predictions).select("request_id", "n_terms", "max_score", "first_term")
    assert sorted(map(tuple, short.collect()), key=str) == [("r1", 2, 0.7, "t2"), ("r2", 0, 0.0, None), ("r3", 0, 0.0, None)]


def test_dashboard_of_a_user_and_of_an_admin(spark):
    at = datetime(2024, 1, 15, 9, 0)
    log = [(f"r{k}", f"P{k}", "ann" if k < 2 else "bob", at, at, s, None, 10, 2 * k + n) for k in range(3) for n, s in enumerate(("pending", "completed"))]
    log = spark.createDataFrame(
        log, "request_id string, protein_id string, username string, created_at timestamp, updated_at timestamp,"
        "current_status string, error_code string, latency_ms bigint, seq bigint"
    )
    made = [("r0", "P0", at), ("r0", "P0", at), ("r0", "P9", at), ("r2", "P2", at), ("other", "P5", at), ("r1", "P1", datetime(2024, 1, 17))]
    made = spark.createDataFrame(made, "request_id string, protein_id string, predicted_at timestamp")
    links = spark.createDataFrame([("r0", "P0"), ("r0", "P9"), ("r2", "P2")], "request_id string, protein_id string")
    for user, admin, totals, writes, shown in (
        ("ann", False, (2, 3, 2), (2, 3, 4, 2), ["r0 P0", "r0 P9"]),
        ("root", True, (3, 4, 4), (3, 4, 6, 4), ["other P5", "r0 P0", "r0 P9", "r2 P2"]),
    ):
        rows = requests.dashboard_summary(log, made, links, user, admin, date(2024, 1, 15), datetime(2024, 1, 15, 9, 30)).collect()
        of = lambda section, rows=rows: {r.item: r.value for r in rows if r.section == section}
        assert tuple(of("total")[n] for n in ("total_today", "protein_count", "prediction_count")) == totals
        names = ("requests_by_day", "request_proteins_by_request", "request_timeline_by_id", "prediction_by_request")
        assert tuple(of("writes")[n] for n in names) == writes and len(of("writes")) == 11
        assert sorted(of("recent_prediction")) == shown
