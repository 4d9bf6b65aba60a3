from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from lifetide.llm import pitman_yor as py
from lifetide.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark, messy):
    return py.train(messy)


def test_probabilities_sum_to_one_in_every_context(model):
    words = model.words.collect()
    p = np.array([r["p1"] for r in words]) @ model.fallback / model.fallback.shape[0]
    for i, r in enumerate(words):
        p[i, r["context"]] += r["a"]
    assert (p > 0).all()
    assert np.allclose(p.sum(axis=0) + model.unknown @ model.fallback / model.fallback.shape[0], 1)


def test_both_ways_of_scoring_agree(spark, messy, model):
    def run(head):
        return sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 4), round(r["score"], 2)) for r in py.score(messy, model, head).collect())

    assert run(1 << 17) == run(20) == run(0)


def test_a_fixed_cycle_is_predicted(spark):
    """500 equally frequent words in one order: the next word is certain."""
    words = [f"w{i}" for i in range(500)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 500 :] + words[: i % 500])) for i in range(1000)], "doc_id long, text string")

    def perplexity(model):
        r = py.score(docs, model).groupBy().sum("score", "n_tokens").first()
        return 10 ** (-r[0] / r[1])

    assert perplexity(py.train(docs)) < 1.1
    assert perplexity(py.train(docs, 64)) > 50  # most words share a restaurant


def test_tokens_read_beside_the_model_as_one_by_one(spark, messy, model):
    """Every text's score from the stored model, token by token."""
    rows = {r["w"]: r for r in model.words.collect()}
    want = []
    for doc_id, text in messy.select("doc_id", "text").collect():
        found, first = py.tokens(py.pa.array([text or ""]), py.WordReader())
        total = 0.0
        for w, u in zip(found.view(np.int64).tolist(), py.contexts(found, first, model.frequent).tolist()):
            r = rows.get(w)
            p = float(np.mean((np.array(r["p1"]) if r else model.unknown) * model.fallback[:, u]))
            if r and u in r["context"]:
                p += r["a"][r["context"].index(u)]
            total += math.log10(p)
        want.append((str(doc_id), len(found), round(total, 3)))
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # words go on over batches
    try:
        got = [(str(r["doc_id"]), r["n_tokens"], round(r["score"], 3)) for r in py.score(messy, model, 50).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)
    assert sorted(got) == sorted(want)


def partitions(n, t):
    """Sizes of the tables of all ways to seat n customers at t tables."""
    if n == 0:
        return [()] if t == 0 else []
    out = []
    for p in partitions(n - 1, t):
        out += [p[:i] + (p[i] + 1,) + p[i + 1 :] for i in range(len(p))]
    return out + [p + (1,) for p in partitions(n - 1, t - 1)] if t else out


def test_weights_of_seatings_by_enumeration():
    table = py.seatings(0.3, 7)
    for n in range(1, 8):
        for t in range(1, n + 1):
            total = sum(math.prod(i - 0.3 for size in p for i in range(1, size)) for p in partitions(n, t))
            assert math.isclose(math.exp(table[n, t]), total, rel_tol=1e-9)


def test_tables_as_by_reseating_one_customer_after_another():
    """The block draw against a plain Gibbs sampler over single customers."""
    n, d, a = 12, 0.4, 0.7
    key = py.random_bits(np.arange(20_000, dtype=np.uint64), 1, 1)
    got = py.drawn(np.full(len(key), n), lambda rows, j: np.full((len(rows), j.shape[1]), a), py.seatings(d), key, 1)
    rng, tables, sampled = np.random.default_rng(3), [1] * n, []
    for step in range(6000):
        for _ in range(n):
            i = rng.choice(len(tables), p=np.array(tables) / n)
            tables[i] -= 1
            tables = [x for x in tables if x]
            weights = np.array([x - d for x in tables] + [a])
            i = rng.choice(len(weights), p=weights / weights.sum())
            tables = [*tables, 1] if i == len(tables) else tables[:i] + [tables[i] + 1] + tables[i + 1 :]
        sampled.append(len(tables))
    share = lambda x: np.bincount(np.asarray(x, int), minlength=n + 1) / len(x)
    assert np.abs(share(got) - share(sampled)).max() < 0.03


@pytest.mark.parametrize("d", [0.1, 0.5, 0.85])
@pytest.mark.parametrize("a", [0.01, 2.0, 40.0, 3000.0])
def test_many_customers_as_the_exact_distribution(d, a):
    c = 700
    logs = py.seatings(d, c)[c, 1:] + np.arange(1, c + 1) * math.log(a)
    p = np.exp(logs - logs.max())
    p /= p.sum()
    mean = p @ np.arange(1, c + 1)
    sd = math.sqrt(p @ (np.arange(1, c + 1) - mean) ** 2)
    key = py.random_bits(np.arange(20_000, dtype=np.uint64), 1, 1)
    got = py.many_tables(np.full(len(key), float(c)), lambda j: np.full(len(key), a), np.ones(len(key)), d, key, 2)
    assert abs(got.mean() - mean) < 0.15 * sd + 0.7 and abs(got.std() - sd) < 0.1 * sd + 0.4


def test_op5_against_brute_force(spark, messy_dir, messy_rows):
    rows = QUERIES["op5_pitman_yor"](spark, messy_dir).collect()
    tokens = [(i, (t or "").encode().lower().split() + [None]) for i, t in messy_rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, ws in tokens if i is not None and not held(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, ws in tokens:
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        want[str(i), held(i), len(ws), sum(c[w] > 0 for w in ws), n, round(base, 5)] += 1
    got = Counter((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in rows)
    assert got == want


def test_better_than_the_base_on_held_out_texts(spark):
    rows = [r for r in QUERIES["op5_pitman_yor"](spark, "/root/testdata/sf0.01").collect() if r["held_out"]]
    assert rows and all(r["score"] < 0 for r in rows)
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_every_context_has_a_restaurant(spark, monkeypatch):
    """Contexts beyond those with a number: 500 equally frequent words in one order, of which 62 have a number."""
    monkeypatch.setattr(py, "CONTEXTS", 64)
    words = [f"w{i}" for i in range(500)]
    docs = spark.createDataFrame([(i, " ".join(words[i % 500 :] + words[: i % 500])) for i in range(1000)], "doc_id long, text string")
    r = py.score(docs, py.train(docs)).groupBy().sum("score", "n_tokens").first()
    assert 10 ** (-r[0] / r[1]) < 1.1


def test_probabilities_of_all_contexts_as_with_numbers(spark, messy, monkeypatch):
    """With hardly any context numbered: probabilities sum to one in every context, and each token scores as its row says."""
    whole = py.train(messy)
    monkeypatch.setattr(py, "CONTEXTS", 6)
    model = py.train(messy)
    rare = {r["u"]: np.array(r["f"]) for r in model.rare.collect()}
    rows = {r["w"]: r for r in model.words.collect()}
    assert model.settings.discount == whole.settings.discount and len(model.frequent) == 4 and len(rare) > 1000
    some = sorted(rare)[:200]
    p1 = np.array([r["p1"] for r in rows.values()])
    total = {u: float((rare[u] * model.unknown).mean() + (p1 * rare[u]).mean(axis=1).sum()) for u in some}
    for r in rows.values():
        for u, a in zip(r["context"], r["a"]):
            if u in total:
                total[u] += a - float((rare[u] * r["p1"]).mean())
    assert np.allclose(list(total.values()), 1, atol=1e-5)
    # Texts that training has not seen: known and new words in known and new contexts.
    texts = messy.collect()
    new = [(i + 1000, " ".join(w for x in (r["text"], texts[i - 1]["text"]) for w in (x or "").split()[: 40 + i][::-1]) + " neverseen thing and neverseen") for i, r in enumerate(texts[:20])]
    both = spark.createDataFrame([(r["doc_id"], r["text"]) for r in texts] + new, "doc_id long, text string")
    want = []
    for doc_id, text in both.collect():
        found, first = py.tokens(py.pa.array([text or ""]), py.WordReader())
        score = 0.0
        for w, u in zip(found.view(np.int64).tolist(), py.contexts(found, first, model.frequent, True).tolist()):
            r = rows.get(w)
            a = r["a"][r["context"].index(u)] if r and u in r["context"] else 0.0
            near = 0 <= u < model.fallback.shape[1]
            f = model.fallback[:, u] if near else rare.get(u, np.ones(2))
            score += math.log10(a if a and not near else a + float(np.mean((np.array(r["p1"]) if r else model.unknown) * f)))
        want.append((str(doc_id), len(found), round(score, 2)))
    for head in (0, 50, py.HEAD):
        got = [(str(r["doc_id"]), r["n_tokens"], round(r["score"], 2)) for r in py.score(both, model, head).collect()]
        assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 0.03 for a, b in zip(sorted(got), sorted(want))) and len(got) == len(want)
    # The seats are drawn anew, so scores are alike, not equal.
    alike = [py.score(both, m).groupBy().sum("score").first()[0] for m in (whole, model)]
    assert abs(alike[0] / alike[1] - 1) < 0.02
