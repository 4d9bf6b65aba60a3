"""Every query on a messy table and on empty ones: whole results, no crash."""

from __future__ import annotations

import pytest

from lifetide.llm.queries import QUERIES

PER_DOCUMENT = [q for q in QUERIES if q.split("_")[0] in ("op1", "op3", "op4", "op5", "op7", "op9", "op10", "op13")]


@pytest.mark.parametrize("name", PER_DOCUMENT)
def test_one_row_per_document(spark, messy_dir, messy_rows, name):
    ids = [r["doc_id"] for r in QUERIES[name](spark, messy_dir).select("doc_id").collect()]
    key = lambda i: (i is not None, i)
    assert sorted(ids, key=key) == sorted((i for i, _ in messy_rows), key=key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).count() == 0


@pytest.mark.parametrize("name", ["op1_spotsigs", "op5_pitman_yor", "op9_simhash_gray_index"])
def test_repeatable(spark, messy_dir, name):
    run = lambda: sorted(map(str, QUERIES[name](spark, messy_dir).collect()))
    assert run() == run()
