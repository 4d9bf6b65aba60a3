from __future__ import annotations

import re

import numpy as np
import xxhash

from lifetide.llm import simhash
from lifetide.llm.queries import QUERIES


def brute_fingerprint(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    w = re.findall(rb"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[i : i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_roots(nodes, near):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in nodes:
        for b in nodes:
            if a < b and near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {x: find(x) for x in nodes}


def planted(seed=1):
    """Fingerprints in clusters of a few flipped bits, and scattered ones."""
    rng = np.random.default_rng(seed)
    out = set(rng.integers(0, 2**63, 300).tolist())
    for base in rng.integers(0, 2**63, 6).tolist():
        for _ in range(40):
            v = base
            for bit in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                v ^= 1 << bit
            out.add(v)
    return np.array(sorted(out), np.uint64)


def test_gray_rank_is_the_inverse_of_the_code():
    n = np.arange(2000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_index_prunes_no_link():
    fps = planted()
    index = simhash.GrayIndex(fps)
    every = np.ones(-(-len(fps) // simhash.LEAF), bool)
    for q in fps[::7]:
        near = set(index.fps[np.bitwise_count(index.fps ^ q) <= 4].tolist())
        assert set(index.fps[index.near(q, 4, every)].tolist()) == near


def test_components_of_links(spark):
    signed = planted().view(np.int64).tolist()
    want = brute_roots(signed, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for limit in (4096, 30):  # whole groups, and groups cut into parts
        got = {r["node"]: r["root"] for r in simhash.connected(simhash.links(df, limit=limit)).collect()}
        assert all(got.get(x, x) == want[x] for x in signed)


def test_op9_against_brute_force(spark, messy_dir, messy_rows):
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in QUERIES["op9_simhash_gray_index"](spark, messy_dir).collect()]
    prints = [(i, brute_fingerprint(t)) for i, t in messy_rows]
    fps = sorted({f for _, f in prints})
    roots = brute_roots(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    low = {}
    for i, f in prints:
        if i is not None:
            low[roots[f]] = min(i, low.get(roots[f], i))
    want = [(i, f"{f:016x}", low.get(roots[f])) for i, f in prints]
    assert sorted(map(str, got)) == sorted(map(str, want))
