from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from lifetide.llm import packing
from lifetide.llm.bpe import ForcedBoundaryBpe, decode, encode
from lifetide.llm.queries import QUERIES, byte_bpe_path

ALPHABET = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u2003\u3000'’sStlvedm!?.,019٣abcdefghijéüñßzqx日本語😀\u0301a\xad") + [
    "'s", "'ll", "<|endoftext|>", "  ", "   ", "the", " 's", "\n ", " \n", "!'s",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(byte_bpe_path())


def test_ids_and_text_equal_the_library(library):
    rng = random.Random(11)
    bpe = ForcedBoundaryBpe(byte_bpe_path())
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["日本語" * 500, "a" * 3000, "".join(rng.choices("abcdefgh", k=4000)), " " * 500 + "x"]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        packed = bpe.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids
        assert bpe.decode(packed) == library.decode(ids, skip_special_tokens=False)


LONG_RUNS = {
    "spaces": " " * 1_200_000,
    "tabs": "\t" * 1_200_000,
    "mixed": "".join(random.Random(3).choices(" \t\n", k=1_200_000)),
    "words between": (" " * 300_000 + "x") * 3 + "end  " * 20_000,
    "one letter": "a" * 300_000,
}


@pytest.mark.parametrize("text", LONG_RUNS.values(), ids=LONG_RUNS)
def test_very_long_runs(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    packed = ForcedBoundaryBpe(byte_bpe_path()).encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert packing.library_encoder(byte_bpe_path())(text).tolist() == ids


def test_a_very_long_run_is_packed(spark):
    text = LONG_RUNS["spaces"]
    docs = spark.createDataFrame([(1, "a b"), (2, text)], "doc_id long, text string")
    rows = packing.pack(docs, byte_bpe_path()).where("doc_id = 2").orderBy("start").collect()
    ids = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in rows])
    assert ids[-1] == packing.END and len(ids) == rows[0]["doc_tokens"]
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["length"] for r in rows[:-1])]).tolist()
    assert ForcedBoundaryBpe(byte_bpe_path()).decode(ids[:-1].tobytes()) == text


def test_forced_pairs_are_inside_no_token():
    bpe = ForcedBoundaryBpe(byte_bpe_path())
    raw = "zebra-crossing 日本語 xqzj".encode()
    assert b"".join(bpe.cut(raw)) == raw
    joined = b"\n\n".join(bpe.text_of.values())
    for left, right in zip(bpe.cut(raw), bpe.cut(raw)[1:]):
        assert left[-1:] + right[:1] not in joined


def test_round_trip(spark, messy, messy_rows):
    back = decode(encode(messy, byte_bpe_path()), byte_bpe_path()).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((i, t or "") for i, t in messy_rows)


def test_op7_digests(spark, messy_dir, messy_rows, library):
    want = Counter()
    for i, t in messy_rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
    got = Counter(tuple(r) for r in QUERIES["op7_forced_boundary_bpe"](spark, messy_dir).collect())
    assert got == want


def test_fill_finds_the_closest_sum():
    rng = random.Random(2)
    for _ in range(200):
        counts = [0] * 40
        for _ in range(rng.randint(0, 8)):
            counts[rng.randint(1, 39)] += 1
        items = [n for n, c in enumerate(counts) for _ in range(c)]
        room = rng.randint(1, 60)
        sums = {0}
        for n in items:
            sums |= {s + n for s in sums}
        total, used = packing.fill(counts, room)
        assert total == max(s for s in sums if s <= room) == sum(used)
        assert not Counter(used) - Counter(items)


def test_op8_pieces_cover_every_id(spark, messy_dir, messy_rows, library):
    rows = QUERIES["op8_minimum_bin_slack"](spark, messy_dir).collect()
    unique = [(i, t) for i, t in messy_rows if i not in (None, 7, 101)]
    for i, t in unique:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        at = 0
        for r in sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    assert sum(r["length"] for r in rows) == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in messy_rows)
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024 and not at & (at - 1)  # a power of two, so no padding
