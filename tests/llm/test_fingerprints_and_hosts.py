"""SpotSigs and host reputation."""

from __future__ import annotations

import hashlib
import itertools
import random
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from lifetide.llm import host_reputation as hr
from lifetide.llm import spotsigs
from lifetide.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import compare
from tests.llm.conftest import frame


def sigs(spark, texts):
    df = spotsigs.with_signatures(frame(spark, list(enumerate(texts))).select("doc_id", "text"), "text", "sigs")
    return {r["doc_id"]: set(r["sigs"]) for r in df.collect()}


def brute_chains(text):
    """(word, next word) of content words that follow a common word, the start
    or ``STRETCH`` content words."""
    words = "".join(c.lower() if c.isalpha() or c.isdigit() else " " for c in text).split()
    out, content, run, mark = set(), [], 0, True
    for w in words:
        if run == spotsigs.STRETCH:
            mark, run = True, 0
        if w in spotsigs.COMMON:
            mark, run = True, 0
            continue
        content.append((w, mark))
        mark, run = False, run + 1
    for (a, marked), (b, _) in zip(content, content[1:]):
        if marked:
            out.add((a, b))
    return out


def test_chains_follow_common_words(spark):
    texts = [
        "The harbour and lantern of copper meadow, winter signal paper river stone garden",
        "harbour lantern copper meadow winter signal paper river stone",
        "THE the OF harbour!! LANTERN the",
        "und der Fluss im Garten: le jardin de la maison",
    ]
    got = sigs(spark, texts)
    for i, t in enumerate(texts):
        pairs = sorted(brute_chains(t))
        want = {r[0] for r in spark.createDataFrame(pairs, "a string, b string").selectExpr("xxhash64(a, b)").collect()}
        assert got[i] == want


def test_small_texts(spark):
    got = sigs(spark, ["", "###", "one", "One!", "the of", None or "harbour lantern"])
    assert got[0] == set() and len(got[1]) == 1 and got[2] == got[3] and len(got[4]) == 1 and len(got[5]) == 1
    assert got[1] != got[2]


def test_op1_digests_and_likeness(spark, messy_dir, messy_rows):
    rows = QUERIES["op1_spotsigs"](spark, messy_dir).collect()
    order = sorted(messy_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(map(str, ((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows))) == sorted(map(str, want))
    as_set = lambda s: set(s.split(",")) - {""}
    for r in rows:
        a, b = as_set(r["fingerprint"]), as_set(r["edited_fingerprint"])
        exact = len(a & b) / len(a | b) if a | b else 1.0
        assert abs(r["near_edited"] - exact) < 1e-12
        assert 0 <= r["near_next"] <= 1
    by_text = {}
    for i, t in messy_rows:
        by_text.setdefault(t or "", set()).update(r["fingerprint"] for r in rows if r["doc_id"] == i and i not in (None, 7))
    assert all(len(x) <= 1 for x in by_text.values())


def test_next_document_across_ranges(spark):
    ids = [-5, 0, 1, 2, 3, 900, 901, 5000, 5001, 10**12, 10**12 + 1]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    old, spotsigs.RANGE_ROWS = spotsigs.RANGE_ROWS, 2
    try:
        got = {r["doc_id"]: r["next_text"] for r in spotsigs.with_next(docs, ["text"]).collect()}
    finally:
        spotsigs.RANGE_ROWS = old
    assert got == {i: f"t{j}" for i, j in zip(ids, ids[1:] + ids[:1])}


@pytest.mark.parametrize("ids", [
    [*range(400), 2**62], [*range(300), *range(10**12, 10**12 + 300), -(2**62)], [5] * 200 + list(range(200)), [None] * 300 + [1, 2],
], ids=["far", "clusters", "one id", "no id"])
def test_ranges_follow_the_rows(spark, monkeypatch, ids):
    """Every range holds a few documents, and the order of ids (and of the
    hash, for rows with one id) goes through all ranges."""
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 16)
    docs = spark.createDataFrame([(i, f"t{k}") for k, i in enumerate(ids)], "doc_id long, text string").repartition(4)
    own, _ = spotsigs.ranges(docs)
    placed = docs.select("doc_id", "text", own.alias("range"), F.xxhash64("text").alias("h")).collect()
    counts = Counter(r["range"] for r in placed)
    assert max(counts.values()) <= 4 * 16 and len(counts) >= len(ids) // 48
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)
    line = sorted(placed, key=lambda r: (r["range"], key(r)))
    assert [key(r) for r in line] == sorted(map(key, placed))
    after = {(r["doc_id"], r["text"]): r["next_text"] for r in spotsigs.with_next(docs, ["text"]).collect()}
    order = [r["text"] for r in sorted(placed, key=lambda r: (key(r), r["h"] if ids.count(r["doc_id"]) > 1 else 0))]
    text_after = dict(zip(order, order[1:] + order[:1]))
    assert after == {(r["doc_id"], r["text"]): text_after[r["text"]] for r in placed}


def test_likeness_is_exact_however_lengths_differ(spark):
    row = spark.sql("SELECT array(1L) AS a, sequence(1L, 150L) AS b, cast(array() AS array<bigint>) AS c")
    got = row.select(spotsigs.likeness("a", "b"), spotsigs.likeness("a", "c"), spotsigs.likeness("c", "c"), spotsigs.likeness("b", "b")).first()
    assert tuple(got) == (1 / 150, 0.0, 1.0, 1.0)


def test_long_runs_of_common_words_take_linear_time(spark):
    texts = ["the " * 300_000, "the " * 150_000 + "harbour " + "of " * 150_000, "harbour " * 300_000]
    started = time.time()
    got = sigs(spark, texts)
    assert time.time() - started < 30
    assert len(got[0]) == 1 and len(got[1]) == 1 and len(got[2]) == 1


@pytest.mark.parametrize("similarity", [0.5, 0.8])
def test_similar_sets_against_brute_force(spark, similarity):
    rng = random.Random(9)
    rows = []
    for k in range(25):
        base = rng.sample(range(2000), rng.randint(1, 60))
        for _ in range(rng.randint(1, 5)):
            own = [x for x in base if rng.random() < 0.9] + rng.sample(range(2000, 4000), rng.randint(0, 4)) + [5000] * (k % 3 == 0)
            rows.append(sorted(set(own)))
    rows += [rows[0], rows[0], []]
    docs = [(i * 7 % 1009, r) for i, r in enumerate(rows)] + [(None, rows[1]), (None, [9999])]
    members, links = spotsigs.similar(spark.createDataFrame(docs, "doc_id long, sigs array<long>"), similarity)
    name = {}
    for i, r in docs:
        if i is not None:
            name[tuple(r)] = min(i, name.get(tuple(r), i))
    assert sorted(map(str, members.collect())) == sorted(str(Row(doc_id=i, class_id=name[tuple(r)])) for i, r in docs if tuple(r) in name)
    want = set()
    for (x, a), (y, b) in itertools.combinations(name.items(), 2):
        if x and y and len(set(x) & set(y)) / len(set(x) | set(y)) >= similarity:
            want.add((min(a, b), max(a, b)))
    assert want and {(r["a"], r["b"]) for r in links.collect()} == want and links.count() == len(want)


URLS = [
    "https://A.Example.ORG/en/12?x", "http://example.org/es/5", "http://notexample.org/es/5", "http://org/x", "http://x.org", "http://a.com/de/",
    "http://a.com/fr/1#t", "http://a.com/en/1", "no-scheme/path", None, "ftp://u@h.net:80/en/7", "x://y://z/fr/", "http://?q", "http://com/de/1",
]


def test_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").select("page_id", *hr.parts("url"))
    got = {r["page_id"]: (r["host"], r["path"], r["rule"]) for r in df.withColumn("rule", hr.matching_rule(hr.RULES, "text")).collect()}
    assert got[0] == ("a.example.org", "/en/12", "example.org/en/1")
    assert got[1] == ("example.org", "/es/5", "example.org/es/")
    assert got[2] == ("notexample.org", "/es/5", "org/")
    assert got[3] == ("org", "/x", "org/") and got[4] == ("x.org", "", None)
    assert got[5] == ("a.com", "/de/", "com/de/") and got[6] == ("a.com", "/fr/1", "com/fr/") and got[7][2] is None
    assert got[8] == ("", "", None) and got[9] == ("", "", None) and got[10] == ("u@h.net:80", "/en/7", None)
    assert got[11] == ("y:", "//z/fr/", None) and got[12] == ("", "", None) and got[13][2] == "com/de/"


def test_bad_hosts_are_blocked_and_new_ones_shrink(spark):
    out = [("good.net", 1)] * 300 + [("good.net", 0)] * 10 + [("bad.net", 0)] * 60 + [("fine.org", 1)] * 50 + [("a.spam.info", 0)] * 40 + [("b.spam.info", 0)] * 40
    outcomes = spark.createDataFrame([*out, (None, 1), ("x.net", None)], "host string, good int")
    urls = ["http://good.net/a", "http://bad.net/a", "http://new.spam.info/a", "http://unseen.xyz/a", "http://example.org/es/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r["verdict"] for r in hr.judge(pages, outcomes).collect()}
    assert got == {0: "allow", 1: "block", 2: "block", 3: "allow", 4: "block"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op2_equals_its_sql(spark, sf):
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/{sf}/{t}.parquet')")
    ok, message = compare(QUERIES["op2_host_reputation"](spark, f"/root/testdata/{sf}"), con, ORACLE_SQL["op2_host_reputation"])
    assert ok, message


HOSTED = [
    "http://a.shop.co.uk/x", "http://b.shop.co.uk/x", "http://other.co.uk/x", "http://co.uk/x", "http://10.0.0.1/x", "http://10.0.0.2:80/x",
    "http://me@10.0.0.1:8080/x", "http://[::1]:80/x", "http://www.example.com/en/7", "http://plain/x", "http://deep.a.b.example.org/en/2", "ftp:no", "", None,
    "HTTP://WWW.Example.COM/en/3#x", "http://x.example.net/en/5", "http://x.example.net/en/6", "http://y.spam.info/en/8",
]


def test_levels_of_suffixes_and_addresses(spark):
    hosts = spark.createDataFrame([(h,) for h in ("a.shop.co.uk", "co.uk", "10.0.0.1", "me@10.0.0.1:80", "[::1]:80", "www.example.com:80", "plain", "")], "host string")
    got = [tuple(r)[1:] for r in hosts.select("host", *hr.levels("host")).collect()]
    assert got == [
        ("shop.co.uk", "co.uk"), ("co.uk", "co.uk"), ("10.0.0.1", "(address)"), ("10.0.0.1", "(address)"), ("[::1]", "(address)"),
        ("example.com", "com"), ("plain", "plain"), ("", ""),
    ]
    assert [tuple(r) for r in hosts.limit(1).select(*hr.levels("host", [])).collect()] == [("co.uk", "uk")]


def test_op2_on_suffixes_addresses_nulls_and_repeated_rows(spark, tmp_path):
    """Equal to its SQL on hosts of every kind; other columns are not read."""
    pages = [(i, u, f"{i}") for i, u in enumerate(HOSTED)] + [(0, HOSTED[0], "x"), (None, HOSTED[5], None), (99, None, None)]
    frame_ = spark.createDataFrame([(*p, 1, "r") for p in pages], "page_id long, url string, html string, n1 int, domain string")
    frame_.write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(1, 9)] + [(5, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    out = QUERIES["op2_host_reputation"](spark, str(tmp_path))
    ok, message = compare(out, con, ORACLE_SQL["op2_host_reputation"])
    assert ok and out.count() == len(pages), message


def test_op2_reads_each_table_once_after_the_counts(spark):
    plan = QUERIES["op2_host_reputation"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("pages.parquet") == 1 and "labels.parquet" not in plan
