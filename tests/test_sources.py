import json

import pytest

from seqloom.sources import readers, tables, writers


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_fasta_golden(spark, tmp_path):
    path = put(tmp_path / "a.fasta", ">sp|P9WHI7|RECN_MYCT desc\nmkv\nLL\n\n>q2 some text\r\nAA BB\r\n>empty\n>q2\nCC\n")
    token = readers.read_fasta(spark, path).collect()
    assert [(r.protein_id, r.sequence) for r in token] == [("sp|P9WHI7|RECN_MYCT", "MKVLL"), ("q2", "AABB"), ("empty", ""), ("q2", "CC")]
    assert token[1].description == "some text"
    got = readers.read_fasta(spark, path, id_mode="accession", upper=False, on_empty="drop").collect()
    assert [(r.protein_id, r.sequence) for r in got] == [("P9WHI7", "mkvLL"), ("q2", "AABB"), ("q2", "CC")]
    last = {r.protein_id: r.sequence for r in readers.read_fasta(spark, path, last_wins=True).collect()}
    assert last["q2"] == "CC"
    with pytest.raises(Exception, match="without sequence lines"):
        readers.read_fasta(spark, path, on_empty="error").collect()


def test_fasta_split_over_many_tasks(spark, tmp_path):
    records = {f"p{i}": "MKLV" * (i % 50 + 1) for i in range(3000)}
    path = put(tmp_path / "big.fasta", "".join(f">{k}\n{v}\n" for k, v in records.items()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = readers.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert {r.protein_id: r.sequence for r in df.collect()} == records
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sequence_dir(spark, tmp_path):
    put(tmp_path / "x" / "b.fa", ">r1\nmk\n>r2\n\n>r3\nlv\n")
    put(tmp_path / "x" / "a" / "plain.TXT", "mk lv\naa\n")
    put(tmp_path / "x" / "skip.csv", ">no\nAA\n")
    got = [(r.protein_id, r.sequence, r.record_index) for r in readers.read_sequence_dir(spark, str(tmp_path / "x")).orderBy("source_file", "record_index").collect()]
    assert got == [("plain", "MKLVAA", 0), ("r1", "MK", 0), ("r3", "LV", 1)]
    assert readers.read_sequence_dir(spark, str(tmp_path / "x"), limit=2).count() == 2


def test_tables_and_lists(spark, tmp_path):
    path = put(tmp_path / "s.tsv", "protein_id\tsequence\nx\tm k\n")
    assert readers.read_sequence_table(spark, path).first().sequence == "MK"
    with pytest.raises(ValueError, match="missing columns: nope"):
        readers.read_sequence_table(spark, path, "nope")
    ids = put(tmp_path / "ids.txt", "a one\n\n  b\n")
    assert [r[0] for r in readers.read_id_list(spark, ids).collect()] == ["a", "b"]
    terms = put(tmp_path / "t.json", json.dumps(["x", "y"], indent=1))
    assert [tuple(r) for r in readers.read_term_list(spark, terms).collect()] == [(0, "x"), (1, "y")]


OBO = """format-version: 1.2

[Term]
id: GO:1
name: one
namespace: molecular_function
def: "A \\"quoted\\" text with \\\\ slash." [x:y]
is_a: GO:2 ! two
relationship: part_of GO:3 ! three
relationship: regulates GO:4

[Term]
id: GO:2
name: two
namespace: molecular_function
is_obsolete: true

[Typedef]
id: part_of
name: part of
namespace: external
"""


def test_obo(spark, tmp_path):
    terms, edges = readers.read_obo(spark, put(tmp_path / "go.obo", OBO))
    row = terms.collect()
    assert [(r.term, r.name, r.namespace, r.definition) for r in row] == [("GO:1", "one", "molecular_function", 'A "quoted" text with \\ slash.')]
    assert sorted(tuple(r) for r in edges.collect()) == [("GO:1", "GO:2", "is_a"), ("GO:1", "GO:3", "part_of")]


def test_submission(spark, tmp_path):
    path = put(tmp_path / "s.tsv", "P1\tGO:1\t0.5\nP2 Text 0.123 some free  text\nP3\tGO:2\tbad\n")
    predictions, texts = readers.read_submission(spark, path)
    assert [tuple(r) for r in predictions.collect()] == [("P1", "GO:1", 0.5), ("P3", "GO:2", None)]
    assert [tuple(r) for r in texts.collect()] == [("P2", 0.123, "some free  text")]


def test_eval_results(spark, tmp_path):
    put(tmp_path / "a" / "evaluation_all.tsv", "filename\tns\ttau\tf\nm.tsv\tBP\t0.1\t0.5\n")
    put(tmp_path / "a" / "evaluation_best_f.tsv", "filename\tns\ttau\tf\nm.tsv\tBP\t0.2\t0.6\n")
    got = readers.read_eval_results(spark, {"set": str(tmp_path / "a")}).collect()
    assert sorted((r._result_set, r._metric, r.f) for r in got) == [("set", "all", "0.5"), ("set", "f", "0.6")]


def test_written_events_and_truncation(spark, tmp_path):
    df = spark.createDataFrame([("p", 1)], "protein_id string, n int")
    writers.write_events(df, "protein_id", "topic_a", path=str(tmp_path / "e"))
    row = spark.read.json(str(tmp_path / "e")).first()
    assert (row.key, json.loads(row.value), row.topic) == ("p", {"protein_id": "p", "n": 1}, "topic_a")
    with pytest.raises(ValueError):
        writers.write_events(df, "protein_id", "topic_a")
    df.write.parquet(str(tmp_path / "t"))
    tables.truncate_tables(spark, {"requests_by_day": str(tmp_path / "t")})
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def test_scratch_folder_follows_the_session(spark):
    from seqloom.operators.lineage import cut_lineage, scratch_root

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert scratch_root(spark) == named.rstrip("/")
    assert cut_lineage(spark.range(3)).count() == 3


def test_sequence_files_are_opened_once(spark, tmp_path):
    for name, text in (("a.fasta", ">x\nMK\n>y\nML\n"), ("b.txt", "mk\nml\n")):
        (tmp_path / name).write_text(text)
    rows = readers.read_sequence_dir(spark, str(tmp_path))
    for name in ("a.fasta", "b.txt"):
        (tmp_path / name).unlink()
    assert sorted((r.protein_id, r.sequence, r.record_index) for r in rows.collect()) == [("b", "MKML", 0), ("x", "MK", 0), ("y", "ML", 1)]
