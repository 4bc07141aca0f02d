import hashlib
import json

from pyspark.sql import functions as F

from seqloom.functions import payload as P
from seqloom.functions import scalars as S
from seqloom.functions import validate as V


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_golden_event(spark):
    raw = json.dumps({
        "request_id": "r1", "protein_id": " p1 ", "sequence": "mte yk\nlv", "source": "api",
        "event_time": "2026-06-04T10:15:00Z", "metadata": {"top_k": "700", "threshold": 1.7},
    })
    parsed = V.parse_events(spark.createDataFrame([(raw,)], "value string"))
    row = V.request_parameters(parsed.valid).first()
    assert (row.protein_id, row.sequence, row.top_k, row.threshold) == ("p1", "MTEYKLV", 500, 1.0)
    assert row.checksum == hashlib.sha256(b"MTEYKLV").hexdigest()
    assert parsed.dead.count() == 0


def test_invalid_events_go_to_dead_letters(spark):
    event = lambda p, s: json.dumps({"request_id": "r", "protein_id": p, "sequence": s})
    bad = [event(" ", "MK"), event("p", " "), event("p", "A" * 20001), event("p", "MTE*"), "{bad", "[1]", "3", ""]
    good = [event("p", "A" * 20000), event("p", "bxzuoj")]
    parsed = V.parse_events(spark.createDataFrame([(v,) for v in bad + good], "value string"))
    dead = parsed.dead.collect()
    assert sorted(json.loads(r.payload)["raw_value"] for r in dead) == sorted(bad)
    assert parsed.valid.count() == len(good)
    assert {r.stage_name for r in dead} == {"spark_validation"} and not any(r.retryable for r in dead)


def test_supplied_checksum_is_kept(spark):
    raw = json.dumps({"request_id": "r", "protein_id": "p", "sequence": "MK", "checksum": "abc"})
    assert V.parse_events(spark.createDataFrame([(raw,)], "value string")).valid.first().checksum == "abc"


def test_normalize_removes_every_unicode_space(spark):
    text = "m k l　v\x1cq\x85\x0b\t w"
    assert values(spark, [(text,)], "s string", S.normalize_sequence(F.col("s")))[0][0] == "".join(text.split()).upper()


def test_profiles(spark):
    rows = [("MKLVAAAAAA",), ("MKL",), ("MBZ",), ("",), ("M" * 10001,)]
    got = values(spark, rows, "s string", *[S.sequence_error(F.col("s"), p) for p in ("event", "api", "ui")])
    assert got[0] == (None, None, None)
    assert got[1] == (None, None, S.UI_SHORT)
    assert got[2] == (None, "Sequence contains unsupported symbols: B, Z.", S.UI_LETTERS)
    assert got[3] == (S.EVENT_BLANK, S.REQUIRED, S.REQUIRED)
    assert got[4] == (None, None, S.UI_LONG)


def test_shard_matches_integer_arithmetic(spark):
    ids = [f"req-{i}" for i in range(50)]
    for n in (1, 7, 32, 1000):
        got = values(spark, [(i,) for i in ids], "s string", S.shard(F.col("s"), n))
        assert [g[0] for g in got] == [int(hashlib.sha256(i.encode()).hexdigest(), 16) % n for i in ids]


def test_parameters(spark):
    ks = [("7",), (" 12 ",), ("7.9",), ("x",), (None,), ("-5",), ("99999999999999999999999",), ("0",)]
    assert [v[0] for v in values(spark, ks, "s string", S.coerce_top_k(F.col("s")))] == [7, 12, 20, 20, 20, 1, 500, 1]
    ts = [("0.3",), ("NaN",), ("2",), ("-1",), ("x",), (None,), ("Infinity",)]
    assert [v[0] for v in values(spark, ts, "s string", S.coerce_threshold(F.col("s")))] == [0.3, None, 1.0, 0.0, None, None, 1.0]


def test_parse_ts(spark):
    rows = [("2026-06-04T10:15:00Z",), ("2026-06-04T10:15:00",), ("2026-06-04",), ("2026-06-04T10:15:00+02:00",), ("junk",)]
    got = values(spark, rows, "s string", F.date_format(S.parse_ts(F.col("s")), "yyyy-MM-dd HH:mm"))
    assert [g[0] for g in got] == ["2026-06-04 10:15", "2026-06-04 03:15", "2026-06-03 17:00", "2026-06-04 08:15", None]


def test_accession_and_text_forms(spark):
    rows = [("sp|P9WHI7|RECN_MYCT desc",), (">tok rest",), ("a||b",)]
    assert [v[0] for v in values(spark, rows, "h string", S.accession(F.col("h")))] == ["P9WHI7", "tok", "a||b"]
    row = values(spark, [("MUK",)], "s string", S.lm_text(F.col("s")), S.encode_sequence(F.col("s"), 5), S.kmer_list(F.col("s"), 2))[0]
    assert row == ("M X K", [11, 0, 9, 0, 0], ["MU", "UK"])


def test_confidence_texts(spark):
    empty = F.create_map().cast("map<string,double>")
    full = F.create_map(F.lit("a"), F.lit(0.5), F.lit("b"), F.lit(0.25))
    assert values(spark, [(1,)], "x int", S.confidence_summary(empty), S.confidence_summary(full))[0] == (
        "top_terms=0;max_score=0.000000", "top_terms=2;max_score=0.500000",
    )


def test_terms_of_payload(spark):
    payloads = [
        {"top_terms": [{"go_term": "GO:1", "score": "0.3", "aspect": "F"}, {"id": "GO:2"}, "GO:3", {"x": 1}],
         "score_map": {"GO:2": 0.9}, "top_scores": [0.1, 0.2, 0.5]},
        {"top_terms": [], "predicted_terms": ["a", "b"], "top_scores": [0.1, 0.2]},
        {"predictions": [{"term_id": "t", "value": 0.4}]},
    ]
    got = values(spark, [(json.dumps(p),) for p in payloads], "p string", P.terms_of(F.col("p")))
    assert [[(t.term_id, t.score) for t in row[0]] for row in got] == [
        [("GO:2", 0.9), ("GO:3", 0.5), ("GO:1", 0.3)], [("b", 0.2), ("a", 0.1)], [("t", 0.4)],
    ]
    assert got[0][0][2].ontology == "MF"


def test_score_map_keeps_first_place_and_last_value(spark):
    rows = [([("m", "p", "x", 0.1, None, None), ("m", "p", "y", 0.2, None, None), ("m", "p", "x", 0.3, None, None)],)]
    schema = f"r array<struct<{P.ROW_SCHEMA.replace(' STRING', ':string').replace(' DOUBLE', ':double')}>>"
    assert list(values(spark, rows, schema, P.score_map(F.col("r")))[0][0].items()) == [("x", 0.3), ("y", 0.2)]


def test_decode_rows_skips_malformed(spark):
    rows = [(['{"go_term":"a","score":0.5}', "{bad", "[1]", "3", '{"go_term":"b"}'],)]
    got = values(spark, rows, "r array<string>", P.decode_rows(F.col("r")))[0][0]
    assert [(r.go_term, r.score) for r in got] == [("a", 0.5), ("b", None)]


def test_column_names(spark):
    assert P.dedupe_names(["a", " a", "b", "a "]) == ["a", "a__dup1", "b", "a__dup2"]
    cols = ["Filename", "NS", "tau", "f", "f_w", "my_micro_f_w"]
    assert P.resolve_column(cols, ["filename"]) == "Filename"
    assert P.resolve_column(cols, ["nope"], ["micro", "w"]) == "my_micro_f_w"
    assert P.resolve_column(cols, ["nope"]) is None


def test_top_k_of_json_values(spark):
    told = ["7.9", "1e3", "true", "false", '" 12 "', '"7.9"', "-3", "null", '"x"', "[1]", "1e30"]
    df = spark.createDataFrame([(i, '{"top_k": %s}' % t) for i, t in enumerate(told)] + [(99, "{"), (98, None)], "i int, metadata string")
    got = {r.i: r.top_k for r in V.request_parameters(df).collect()}
    assert [got[i] for i in range(len(told))] == [7, 500, 1, 1, 12, 20, 1, 20, 20, 20, 500]
    assert got[99] == got[98] == 20


def test_events_are_parsed_once(spark):
    raw = spark.createDataFrame([('{"protein_id": "p"}',)], "value string")
    parsed = V.parse_events(raw)
    for rows in parsed:
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_items_of_a_payload_are_parsed_once(spark):
    texts = ['{"top_terms":["GO:1",{"go_term":"GO:2","score":0.5}],"score_map":{"GO:1":0.7}}', '{"predictions":[],"predicted_terms":["GO:3"]}', None]
    rows = spark.createDataFrame([(t,) for t in texts], "value string").select("value", P.terms_of(F.col("value")).alias("t"))
    plan = rows._jdf.queryExecution().analyzed().toString()
    assert plan.count("from_json") == 3  # the payload, items of the main list, items of the spare one
    got = {r.value: r.t and [(t.term_id, t.score) for t in r.t] for r in rows.collect()}
    assert [got[t] for t in texts[:2]] == [[("GO:1", 0.7), ("GO:2", 0.5)], [("GO:3", 0.0)]]
