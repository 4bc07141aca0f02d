import json
import sys
import time
from datetime import datetime, timedelta
from pathlib import Path

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from seqloom.operators import dedupe, requests
from seqloom.operators.lineage import scratch_root
from seqloom.sources.store import Store
from seqloom.sources.writers import send_messages
from seqloom.streaming import events as E
from seqloom.streaming import fanout
from seqloom.streaming import pipeline as P
from seqloom.streaming.sinks import drain

# the workers cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def messages(ids, **extra):
    return [json.dumps({"request_id": f"r{i}", "protein_id": f"p{i % 4}", "sequence": "MK" + "LVAG"[i % 4], **extra}) for i in ids]


def model(frame, top_k, threshold):
    if top_k == 3:
        raise RuntimeError("boom")
    return pd.DataFrame({"protein_id": frame["protein_id"], "go_term": "GO:1", "score": 0.5})


def put(folder, name, lines):
    (folder / "topic=raw").mkdir(parents=True, exist_ok=True)
    (folder / "topic=raw" / name).write_text("\n".join(lines) + "\n")


def test_pipeline_counts_restart_and_second_batch(spark, tmp_path):
    source, sinks = tmp_path / "in", P.BatchSinks(str(tmp_path / "out"))
    put(source, "a.txt", messages(range(6)) + ["{bad", *messages([100], metadata={"top_k": 3}, protein_id="z")])

    def run():
        stream = E.read_events(spark, str(source), {"raw": "raw_input"})
        P.run_pipeline(stream, model, sinks, str(tmp_path / "cp"), once=True).awaitTermination()

    def statuses():
        found = P.read_sink(spark, sinks, "request_status").groupBy("current_status").count().collect()
        return {r.current_status: r["count"] for r in found}

    run()
    first = {"VALIDATED": 7, "SKIPPED": 2, "PROCESSING": 5, "SUCCEEDED": 4, "FAILED": 1}
    assert statuses() == first
    dead = P.read_sink(spark, sinks, "dead_letters").collect()
    assert sorted((r.stage_name, r.retryable) for r in dead) == [("modal_inference", True), ("spark_validation", False)]
    assert json.loads(next(r.payload for r in dead if r.retryable))["request_id"] == "r100"
    points = {r.metric_name: r.metric_value for r in P.read_sink(spark, sinks, "pipeline_metrics").collect()}
    want = {"input_events": 8, "valid_events": 7, "duplicate_events": 2, "predictions": 4, "failures": 1}
    assert {k: points[f"spark_batch_{k}"] for k in want} == want
    row = P.read_sink(spark, sinks, "predictions").first()
    assert (row.score_map, row.confidence_summary) == ({"GO:1": 0.5}, "top_terms=1;max_score=0.500000")

    run()  # nothing new: nothing changes
    assert statuses() == first
    put(source, "b.txt", messages([7]))
    run()
    assert statuses()["SUCCEEDED"] == 5
    assert P.read_sink(spark, sinks, "predictions").select("batch_id").distinct().count() == 2


def test_a_repeated_batch_overwrites_itself(spark, tmp_path):
    sinks = P.BatchSinks(str(tmp_path / "out"))
    batch = spark.createDataFrame([(m, 0, i) for i, m in enumerate(messages(range(5)))], "value string, part long, position long")
    for _ in range(2):
        P.persist_batch(batch, 7, model, sinks)
    assert P.read_sink(spark, sinks, "raw_protein_events").count() == 5


def test_chunks_of_64_with_equal_parameters(spark):
    sizes = []

    def count(frame, top_k, threshold):
        return pd.DataFrame({"protein_id": frame["protein_id"], "go_term": str(len(frame)), "score": float(top_k)})

    df = spark.range(200).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.concat(F.lit("p"), "id").alias("protein_id"), F.lit("MK").alias("sequence"),
        F.when(F.col("id") < 150, 20).otherwise(5).alias("top_k"), F.when(F.col("id") < 150, F.lit(None).cast("double")).otherwise(F.lit(0.5)).alias("threshold"), "id",
    )
    out = P.score_batches(df, count, ["id"]).collect()
    sizes = sorted(int(r.predictions[0].go_term) for r in out)
    assert sizes == sorted([64] * 64 + [64] * 64 + [22] * 22 + [50] * 50)


def test_chunks_that_reach_python_together_are_calls_of_their_own(spark):
    def picky(frame, top_k, threshold):
        if "p70" in set(frame["protein_id"]):
            raise RuntimeError("no")
        return pd.DataFrame({"protein_id": frame["protein_id"], "go_term": str(len(frame)), "score": 0.5, "model": str(list(frame.index) == list(range(len(frame))))})

    df = spark.range(64 * 20).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.concat(F.lit("p"), "id").alias("protein_id"), F.lit("MK").alias("sequence"),
        F.lit(20).alias("top_k"), F.lit(None).cast("double").alias("threshold"), "id",
    )
    scored = P.score_batches(df, picky, ["id"])
    out = scored.withColumn("task", F.spark_partition_id()).collect()
    lost = {int(r.request_id[1:]) for r in out if r.error_code == "RuntimeError"}
    assert lost == set(range(64, 128)) and len(out) == 64 * 20
    assert {(r.predictions[0].go_term, r.predictions[0].model) for r in out if r.error_code is None} == {("64", "True")}
    assert all(r.predictions is None for r in out if r.error_code is not None)
    assert "_together" in scored._jdf.queryExecution().optimizedPlan().toString()


def test_sent_messages_are_packed(spark, tmp_path):
    rows = spark.range(500).select(F.col("id").cast("string").alias("key"), F.lit("t").alias("topic"), F.concat(F.lit('{"request_id":"r'), "id", F.lit('"}')).alias("value"))
    send_messages(rows.coalesce(1), path=str(tmp_path / "e"))
    files = [f for f in (tmp_path / "e").rglob("part-*") if f.is_file()]
    assert files and sum(f.stat().st_size for f in files) < 500 * 20
    assert sorted(spark.read.json(str(tmp_path / "e")).select("key", "topic", "value").collect()) == sorted(rows.select("key", "topic", "value").collect())


def test_a_crash_between_two_tables_shows_no_part_of_a_batch(spark, tmp_path, monkeypatch):
    started_at = time.time()
    sinks = P.BatchSinks(str(tmp_path / "out"), events_path=str(tmp_path / "events"))
    put_ = lambda ids, n: P.persist_batch(spark.createDataFrame([(m, 0, i) for i, m in enumerate(messages(ids))], "value string, part long, position long"), n, model, sinks)
    put_(range(4), 0)
    names = [n for n in sinks.store(spark).names() if n != "pipeline_metrics_by_window"]
    held = {n: P.read_sink(spark, sinks, n).count() for n in names}
    whole = P._tables_of

    def broken(*args):
        tables = whole(*args)
        lost = tables["request_timeline_by_id"]
        return tables | {"request_timeline_by_id": lost.withColumn("status", F.raise_error(F.lit("lost executor")).cast("string"))}

    monkeypatch.setattr(P, "_tables_of", broken)
    with pytest.raises(Exception, match="lost executor"):
        put_(range(10, 14), 1)
    assert {n: P.read_sink(spark, sinks, n).count() for n in names} == held
    sent = lambda: spark.read.json(str(tmp_path / "events")).count()
    before = sent()
    monkeypatch.setattr(P, "_tables_of", whole)
    put_(range(10, 14), 1)
    assert P.read_sink(spark, sinks, "request_status_by_id").count() == 8
    assert P.read_sink(spark, sinks, "raw_protein_events").count() == 8
    assert sent() == 2 * before
    put_(range(10, 14), 1)  # comes again: nothing is written or sent twice
    assert sent() == 2 * before and P.read_sink(spark, sinks, "request_status").count() == 24
    left = [p for p in Path(scratch_root(spark)).rglob("*.parquet") if p.stat().st_mtime > started_at]
    assert not left, "what a batch cuts is removed"


def test_fan_out_whatever_the_order(spark, tmp_path):
    """A dictionary per table against the stream, with late, repeated and unusable events."""
    at = lambda m: (datetime(2024, 1, 1) + timedelta(minutes=m)).strftime("%Y-%m-%dT%H:%M:%SZ")
    status = [{"request_id": f"r{i % 5}", "protein_id": "p", "current_status": f"S{i}", "created_at": at(i), "updated_at": at((i * 7) % 40)} for i in range(40)]
    result = [{"request_id": "r1", "protein_id": "P9", "predicted_at": at(60), "top_terms": [{"go_term": "GO:1", "score": 0.5}, "GO:2"], "threshold": 0.1}]
    dead = [{"request_id": "r2", "failed_at": at(70), "message": "no"}, {"failed_at": at(71)}]
    lines = [("request_status", s) for s in status] + [("prediction_result", r) for r in result] + [("dead_letter", x) for x in dead] + [("ping", {"request_id": "x"})]
    rows = [(json.dumps(v), k) for k, v in lines] + [("{bad", "request_status")]
    store = fanout.view_store(spark, str(tmp_path / "s"))
    for n in range(4):
        fanout.persist_events(spark.createDataFrame(rows[n::4], "value string, event_type string"), n, store)
        fanout.persist_events(spark.createDataFrame(rows[n::4], "value string, event_type string"), n, store)
        if n == 1:
            store.compact()
    want = {}
    for s in status:
        want[s["request_id"]] = max(want.get(s["request_id"], ("", "")), (s["updated_at"], s["current_status"].lower()))
    want["r1"], want["r2"] = (at(60), "completed"), (at(70), "failed")
    found = {r.request_id: r for r in store.read("request_status_by_id").collect()}
    assert {k: r.current_status for k, r in found.items()} == {k: v for k, (_, v) in want.items()}
    first = {k: min(s["created_at"] for s in status if s["request_id"] == k) for k in want}
    assert {k: r.created_at.strftime("%Y-%m-%dT%H:%M:%SZ") for k, r in found.items()} == first
    best = store.read("latest_prediction_by_protein").first()
    assert (best.predicted_terms, best.score_map, best.prediction_rows) == (["GO:1", "GO:2"], {"GO:1": 0.5, "GO:2": 0.0}, ['{"go_term":"GO:1","score":0.5}'])
    assert [tuple(r) for r in store.read("failed_requests_by_time").select("request_id", "status_code", "reason").collect()] == [("r2", "UNKNOWN", "no")]
    assert fanout.read_view(store, "requests_by_status_window").count() == 5
    assert store.read("request_timeline_by_id").count() == 40 + 2 + 2


def test_histogram_with_expiring_state(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [(f"r{i}", start + timedelta(hours=i), "Processing" if k == 0 else ["completed", "FAILED"][i % 2], 2 * i + k) for i in range(60) for k in range(2)]
    rows.sort(key=lambda r: (r[1], r[3]))
    kind = "request_id string, updated_at timestamp, current_status string, seq int"
    path = tmp_path / "in"
    for n in range(6):
        spark.createDataFrame(rows[n * 20 : n * 20 + 20], kind).coalesce(1).write.mode("append").parquet(str(path))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(path))
    store = Store(spark, str(tmp_path / "s"))
    query = E.run_histogram(stream, store, str(tmp_path / "cp"), once=True, ttl="5 hours", delay="1 hour")
    query.awaitTermination()
    got = {r.current_status: r.n for r in E.read_histogram(store).collect()}
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    # requests of the last six hours before the last watermark: what is older has left state and counts
    assert sum(got.values()) == held[-1] <= 8 and set(got) == {"completed", "failed"}
    assert max(held) <= 18 < 60
    E.run_histogram(stream, store, str(tmp_path / "cp"), once=True, ttl="5 hours", delay="1 hour").awaitTermination()
    assert {r.current_status: r.n for r in E.read_histogram(store).collect()} == got


def test_histogram_follows_requests_in_groups(spark, tmp_path, monkeypatch):
    start = datetime(2024, 1, 1)
    data = [(f"r{i * 7 % 30}" if i % 11 else None, start + timedelta(hours=i // 4), ["Processing", "completed", "FAILED"][i * i % 3], i) for i in range(200)]
    kind = "request_id string, updated_at timestamp, current_status string, seq int"
    for n in range(4):
        spark.createDataFrame(data[n * 50 : n * 50 + 50], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run(groups, ttl):
        monkeypatch.setattr(E, "FOLLOWED_TOGETHER", groups)
        place = str(tmp_path / f"{groups}-{ttl[:4]}")
        stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        store = Store(spark, f"{place}-s")
        query = E.run_histogram(stream, store, f"{place}-cp", once=True, ttl=ttl, delay="1 hour")
        query.awaitTermination()
        held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
        return {r.current_status: r.n for r in E.read_histogram(store).collect()}, max(held)

    last = {r[0]: r[2].lower() for r in data}
    whole, held = run(2, "9999 days")
    assert whole == {s: list(last.values()).count(s) for s in set(last.values())} and held <= 2
    assert run(1, "5 hours")[0] == run(997, "5 hours")[0] != whole


def test_batches_of_the_fan_out_do_not_grow_with_the_files():
    from seqloom.plans import q_jobs

    batches = lambda n: -(-n // q_jobs.files_together(n))
    assert [batches(n) for n in (1, 2, 7, 24)] == [1, 1, 4, 12]
    assert max(batches(n) for n in range(1, 3000)) <= q_jobs.FANOUT_BATCHES


def test_latency_ring_equals_the_batch_form(spark, tmp_path):
    start = datetime(2024, 1, 1)
    data = [(i * 37 % 101 if i % 9 else None, start + timedelta(seconds=(i * 53) % 400), i) for i in range(400)]
    kind = "latency_ms bigint, updated_at timestamp, seq int"
    spark.createDataFrame(data, kind).repartition(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    store = Store(spark, str(tmp_path / "s"), E.LATENCY_RING)
    E.run_latency(stream, store, str(tmp_path / "cp"), n=70, once=True).awaitTermination()
    newest = [F.desc("updated_at"), F.desc("seq")]
    assert store.read("latency_ring").count() == 70
    ring = E.rolling_latency(store.read("latency_ring"), newest, 70).first()
    assert ring == E.rolling_latency(spark.createDataFrame(data, kind), newest, 70).first()


def status_rows(spark):
    start = datetime(2024, 1, 1)
    data = []
    for i in range(60):
        request = f"r{i % 7}"
        data.append((request, start + timedelta(minutes=i % 7), start + timedelta(minutes=i), ["processing", "Completed", "failed"][i % 3], i))
    return spark.createDataFrame(data, "request_id string, created_at timestamp, updated_at timestamp, current_status string, seq int")


def test_live_status_equals_the_batch_view(spark, tmp_path):
    df = status_rows(spark)
    path = str(tmp_path / "log")
    df.orderBy("seq").repartitionByRange(6, "seq").write.parquet(path)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path)
    live = drain(E.live_status(stream), "update", ["request_id"])
    batch = dedupe.latest_requests(df).withColumn("current_status", F.lower("current_status"))
    pick = lambda d: sorted((r.request_id, r.current_status, r.seq) for r in d.collect())
    assert pick(live) == pick(batch)


def test_events_per_minute_equals_batch_and_restart_adds_nothing(spark, tmp_path):
    df = status_rows(spark).select(F.col("updated_at").alias("ts"))
    path = str(tmp_path / "in")
    df.coalesce(1).write.parquet(path)
    stream = lambda: spark.readStream.schema(df.schema).parquet(path)
    at = {"path": str(tmp_path / "out"), "checkpoint": str(tmp_path / "cp")}
    for _ in range(2):
        got = drain(E.events_per_minute(stream()), "update", ["window_start"], **at)
        assert got.count() == 60 and got.agg(F.sum("metric_value")).first()[0] == 60


def test_retry_and_replay(spark):
    payload = json.dumps({"raw_event": {"request_id": "r", "protein_id": "p", "sequence_raw": "mk", "metadata": {"a": 1}}, "retry_count": 2})
    row = E.retry_events(spark.createDataFrame([(payload,)], "payload string")).first()
    assert (row.request_id, row.sequence, row.retry_count, row.source) == ("r", "MK", 2, "retry_worker")
    assert json.loads(row.metadata) == {"a": "1", "retry_count": "2", "retry_source": "retry_worker"}
    records = spark.createDataFrame([(i, f"p{i}", "MKL") for i in range(10)], "pos int, protein_id string, sequence string")
    events = E.replay(records, "c", ["pos"], every=3, limit=9)
    assert tuple(E.replay_counts(events).first()) == (9, 6, 3)


def test_views_follow_the_latest_row(spark):
    log = status_rows(spark).withColumns({"username": F.lit("u"), "protein_id": F.lit("P1")})
    views = requests.status_views(log)
    assert views["requests_by_status_window"].count() == 7
    assert views["request_timeline_by_id"].count() == 60
