"""Each stage against a plain version on its own input."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from lifetide.llm import compression_classifier as cc
from lifetide.llm import secret_scan
from lifetide.llm import substring_dedup as sd
from lifetide.llm.common import WordHashes, stored, table
from lifetide.llm.queries import byte_bpe_path, quality_model
from tests.llm.conftest import frame, prose
from tests.llm.test_secret_scan import brute as brute_spans
from tests.llm.test_simhash import brute_fingerprint, brute_roots
from tests.llm.test_substring_dedup import framed

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    out = [table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], SF), "test"))
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns(outputs):
    for df in outputs[1:-1]:
        assert df.columns == outputs[0].columns


def test_quality(spark, outputs):
    model = quality_model(outputs[0], table(spark, SF, "labels"))
    before, after = texts(outputs[0]), texts(outputs[1])
    if model.good is None:
        assert before == after
        return
    sizes = cc.Sizes(model.good, model.bad)
    assert set(after) == {i for i, t in before.items() if cc.scores(model, sizes, [t])[0] >= 0.3}
    assert all(after[i] == before[i] for i in after)
    good = {r["doc_id"] for r in table(spark, SF, "labels").where("quality = 1").collect()} & set(before)
    assert len(good & set(after)) > 0.95 * len(good)


def test_near_duplicates(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    prints = {i: brute_fingerprint(t) for i, t in before.items()}
    roots = brute_roots(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i in sorted(before):
        first.setdefault(roots[prints[i]], i)
    assert set(after) == set(first.values()) and all(after[i] == before[i] for i in after)


def test_passages(outputs):
    before, after = texts(outputs[2]), texts(outputs[3])
    assert set(before) == set(after)
    known, seen = WordHashes(), set()
    for i in sorted(after):
        h = set(sd.shingle_hashes((after[i] or "").lower().encode().split(), known, 50).tolist())
        assert not h & seen  # no passage of 50 words is left that an earlier document holds
        seen |= h
    for i in before:
        if after[i] != before[i]:
            assert len(after[i]) < len(before[i])


def test_edited_copies_of_others_lines_are_cut(spark):
    """Smaller documents have each line of the edited copy, and no passage."""
    rng = random.Random(9)
    words = prose(rng, 60).split()
    copy = " ".join([*words[:29], "edited", *words[30:]])
    rows = list(enumerate(framed(rng, [" ".join(words[:29]), " ".join(words[30:]), " ".join(words), copy])))
    after = texts(corpus_pipeline.passages(spark, frame(spark, rows), SF))
    assert {i: after[i] for i in (0, 1, 2)} == dict(rows[:3]) and after[3] == rows[3][1].replace(copy, "")


def test_secrets(outputs):
    before, after = texts(outputs[3]), texts(outputs[4])
    assert set(before) == set(after)
    scanner = secret_scan.Scanner()
    for i in before:
        assert not brute_spans(after[i] or "")
        assert (after[i] == before[i]) == (not scanner.spans(before[i] or ""))


def test_lengths_follow_the_text(outputs):
    assert outputs[4].where("n_chars <> length(text)").count() == 0


def test_packing(outputs):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(byte_bpe_path())
    rows = outputs[5].collect()
    for i, t in texts(outputs[4]).items():
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in mine) == ids.tobytes()
    length = {}
    for r in rows:
        length[r["sequence_id"]] = length.get(r["sequence_id"], 0) + r["length"]
    assert all(n <= 1024 and not n & (n - 1) for n in length.values())


def test_run_is_the_stages(spark, outputs):
    got = {(r["doc_id"], r["start"], zlib.crc32(bytes(r["ids"]))) for r in corpus_pipeline.run(spark, SF).collect()}
    assert {d for d, _, _ in got} == {r["doc_id"] for r in outputs[5].select("doc_id").collect()}


def test_messy_and_empty_tables(spark, messy, empty, messy_dir, empty_dir):
    for docs, folder in ((messy, messy_dir), (empty, empty_dir)):
        for name, stage in corpus_pipeline.STAGES:
            docs = stored(stage(spark, docs, folder), "test")
        assert (docs.count() > 0) == (folder == messy_dir)
