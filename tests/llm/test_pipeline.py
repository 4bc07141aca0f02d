"""The stages in a row: each judged on its own input, by brute force where that is quick."""

from pathlib import Path

import pytest

import corpus_pipeline
from seqloom.llm.common import Scratch, table
from test_documents import brute_leaks, linked_groups

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="generated tables not present")


def test_stages(spark):
    scratch = Scratch(spark)
    tables = [table(spark, FOLDER, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(scratch.cut(stage(spark, tables[-1], FOLDER)))
    rows = [t.collect() for t in tables]
    for before, after in zip(rows[:4], rows[1:5], strict=True):
        assert set(after) <= set(before)
    assert all(t.columns == tables[0].columns for t in tables[:5])

    best = {}
    for r in rows[1]:
        best[r.text or ""] = max(best.get(r.text or "", r.doc_id), r.doc_id)
    assert sorted(r.doc_id for r in rows[2]) == sorted(best.values())

    groups = linked_groups([(r.doc_id, r.text) for r in rows[2]])
    assert sorted(r.doc_id for r in rows[3]) == sorted(i for i, g in groups.items() if g[2])

    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    leaks = {i for i, _ in brute_leaks([(r.doc_id, r.text) for r in rows[3]], items)}
    assert sorted(r.doc_id for r in rows[4]) == sorted({r.doc_id for r in rows[3]} - leaks)

    assert {r.doc_id for r in rows[5]} == {r.doc_id for r in rows[4]}
    used = {}
    for r in rows[5]:
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
