"""Compression classifier and learned decision lists."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from lifetide.llm import compression_classifier as cc
from lifetide.llm import decision_list as dl
from lifetide.llm.common import stored
from lifetide.llm.queries import QUERIES
from tests.llm.conftest import frame, prose, save_tables

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def junk(rng, n):
    kind = rng.randrange(3)
    words = prose(rng, n).split()
    if kind == 0:
        return " ".join(w.upper() + "!!" for w in words)
    if kind == 1:
        return " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in words)
    return " ".join([words[0]] * n)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(420):
        good = rng.random() < 0.7
        rows.append((i, (prose if good else junk)(rng, rng.randint(60, 160))))
        if i % 2 == 0 or i > 300:
            labels.append((i, int(good), 0))
    quality = {i: int(re.search(r"!!|#|\$|%", t) is None and len(set(t.split())) > 5) for i, t in rows}
    folder = save_tables(spark, tmp_path_factory.mktemp("labelled"), frame(spark, rows), labels)
    return folder, quality


def test_op4_on_held_out_rows(spark, labelled):
    folder, quality = labelled
    rows = QUERIES["op4_compression_classifier"](spark, folder).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert sum(r["predicted"] == quality[r["doc_id"]] for r in held) / len(held) > 0.93
    clean = [r for r in held if quality[r["doc_id"]]]
    assert sum(r["predicted"] for r in clean) / len(clean) > 0.95


def plain_score(model, text):
    """The score worked out step by step, every block compressed on its own."""
    import math

    import zstandard

    def size(block, content):
        data = zstandard.ZstdCompressionDict(content)
        made = zstandard.ZstdCompressor(level=cc.LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)
        return len(made.compress(block))

    raw = (text or "").encode()
    parts = [raw[i : i + cc.BLOCK] for i in range(0, len(raw), cc.BLOCK)]
    good, bad = sum(size(p, model.good) for p in parts), sum(size(p, model.bad) for p in parts)
    d = (bad - good + cc.PRIOR * model.mean) / (len(raw) + cc.PRIOR)
    z, short = (d - model.high) / (model.high - model.low), math.exp(-len(raw) / cc.SHORT)
    x = [1, max(-1, min(1, z)) * (1 - short), max(-4, min(1, z)) * short, short]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.curve))))


def test_scores_against_a_plain_version(spark, labelled, messy, messy_rows):
    folder, _ = labelled
    model = cc.train(spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [r for r in messy_rows if r[0] in (10, 11, 103, 200, 201, 202, 203, 206, 207, 208, 211, 212)]
    got = {r["doc_id"]: r["score"] for r in cc.score(frame(spark, rows), model).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert abs(got[i] - plain_score(model, t)) < 1e-9, i


def test_curve_is_the_best_of_its_neighbours():
    """No small change of a coefficient raises the penalised likelihood."""
    rng = np.random.default_rng(5)
    x = np.c_[np.ones(300), rng.standard_normal((300, 3))]
    y, weight = (rng.random(300) < 0.7).astype(float), rng.uniform(0.5, 2, 300)

    def worth(beta):
        p = 1 / (1 + np.exp(-(x @ beta)))
        return (weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() - 0.5 * 1e-2 * (beta**2).sum()

    beta = cc.logistic(x, y, weight)
    for i in range(4):
        for step in (1e-3, -1e-3, 0.1, -0.1):
            assert worth(beta + step * np.eye(4)[i]) < worth(beta)


def test_keep_agrees_with_score(spark, labelled):
    folder, _ = labelled
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = cc.train(docs, labels)
    kept = {r["doc_id"] for r in cc.keep(docs, model, 0.3).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in cc.score(docs, model).where("score >= 0.3").collect()}


def test_without_both_classes(spark, messy):
    labels = spark.createDataFrame([(10, 1), (11, 1), (12, None), (99999, 0)], "doc_id long, quality int")
    model = cc.train(messy, labels)
    assert {r["score"] for r in cc.score(messy, model).collect()} == {1.0}
    assert {r["score"] for r in cc.score(messy, cc.train(messy, labels.limit(0))).collect()} == {0.5}


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count, inside = Counter(grams), set()
    for i, g in enumerate(grams):
        if count[g] > 1:
            inside |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_statistics_against_brute_force(spark, messy, messy_rows):
    extra = ["a b c a b c", "x\n\n \nx\nx y", "a a a a a", "\x0b\x0c q r s", "# <|> b", "a b c d a b c e b c d"]
    rows = messy_rows + [(1000 + i, t) for i, t in enumerate(extra)]
    got = Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        for r in dl.measure(frame(spark, rows)).collect()
    )
    assert got == Counter((i, *brute(t)) for i, t in rows)


def test_rules_separate_held_out_rows(spark, labelled):
    folder, quality = labelled
    rows = QUERIES["op10_decision_list"](spark, folder).collect()
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    held = [r for r in rows if not r["base_failed"]]
    assert sum(r["kept"] == bool(quality[r["doc_id"]]) for r in held) / len(held) > 0.95


def test_rules_are_short_conjunctions(spark, labelled):
    folder, _ = labelled
    measured = stored(dl.measure(spark.read.parquet(f"{folder}/documents.parquet")), "t")
    rules = dl.learn(measured, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rules and all(r and all(c.feature in dl.FEATURES for c in r) for r in rules)
    assert dl.learn(measured, spark.read.parquet(f"{folder}/labels.parquet").limit(0)) == []


BANDS = [(f, lo) for f in "abcdef" for lo in (0.2, 0.7)]


def banded(seed, good, width, each=100):
    """Twelve kinds of bad rows, each within one band of one feature that holds
    no good row."""
    rng = random.Random(seed)
    inside = lambda x: any(lo <= x < lo + width for lo in (0.2, 0.7))

    def clean():
        while inside(x := rng.random()):
            pass
        return x

    rows = [{f: clean() for f in "abcdef"} | {"label": 1} for _ in range(good)]
    for f, lo in BANDS:
        rows += [{g: clean() for g in "abcdef"} | {f: lo + width * rng.random(), "label": 0} for _ in range(each)]
    return rows


def learned(spark, monkeypatch, rows, **more):
    monkeypatch.setattr(dl, "FEATURES", {f: f for f in "abcdef"})
    table = spark.createDataFrame([(i, *[r[f] for f in "abcdef"], r["label"]) for i, r in enumerate(rows)], "doc_id long, a double, b double, c double, d double, e double, f double, label int")
    rules = dl.learn(table.drop("label"), table.selectExpr("doc_id", "label AS quality"), **more)
    rejected = table.withColumn("rule", dl.verdict(rules)).where("rule IS NOT NULL").groupBy("label").count().collect()
    return rules, {r["label"]: r["count"] for r in rejected}


@pytest.mark.parametrize("good,width", [(2000, 0.2), (12000, 0.01)], ids=["wide", "narrow"])
def test_every_kind_of_bad_row_has_a_rule(spark, monkeypatch, good, width):
    rules, rejected = learned(spark, monkeypatch, banded(3, good, width))
    assert len(rules) == len(BANDS)
    assert rejected[0] >= 0.95 * 1200 and rejected.get(1, 0) <= 0.01 * good


def test_labels_without_a_pattern_give_no_rules(spark, monkeypatch):
    rng = random.Random(4)
    rows = [{f: rng.random() for f in "abcdef"} | {"label": int(rng.random() < 0.8)} for _ in range(1500)]
    rules, rejected = learned(spark, monkeypatch, rows)
    assert rejected.get(1, 0) <= 0.01 * len(rows)


def test_first_span_against_exhaustive_search(spark, monkeypatch):
    """The refined span's gain is that of the best of all spans of all values."""
    monkeypatch.setattr(dl, "FEATURES", {f: f for f in "abcdef"})
    rows = banded(8, 400, 0.1, 30)
    bad, good = sum(r["label"] == 0 for r in rows), sum(r["label"] for r in rows)
    best = 0.0
    for f in "abcdef":
        line = sorted((r[f], r["label"]) for r in rows)
        for i in range(len(line)):
            p = n = 0
            for _, label in line[i:]:
                p, n = p + (label == 0), n + label
                best = max(best, dl.foil_gain(p, n, bad, good, 5))
    df = spark.createDataFrame([tuple(r[f] for f in "abcdef") + (r["label"],) for r in rows], ", ".join(f"f_{f} double" for f in "abcdef") + ", label int")
    cuts = dl.every_cut(df)
    found = dl.best_span(df, cuts, bad, good, 5)
    found = dl.refined(df, found, cuts[found[1][0]], bad, good, 5)
    assert found[0] >= 0.97 * best
    (name, low, high), p, n = found[1:]
    held = [r["label"] for r in rows if (low is None or r[name] > low) and (high is None or r[name] <= high)]
    assert (held.count(0), held.count(1)) == (p, n)


def test_repeated_windows_of_a_long_text_are_exact(spark):
    rng = random.Random(12)
    text = " ".join("".join(rng.choices("abcdefgh", k=3)) for _ in range(40_000))
    [row] = dl.measure(frame(spark, [(1, text)])).collect()
    assert row["n_repeat_words"] == brute(text)[4]


def test_native_plans(spark, messy_dir):
    for name in ("op1_spotsigs", "op2_host_reputation", "op10_decision_list"):
        plan = QUERIES[name](spark, messy_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
