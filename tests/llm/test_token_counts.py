from __future__ import annotations

import random

import pytest

from lifetide.llm import token_counts
from lifetide.llm.queries import QUERIES, byte_bpe_path, word_bpe_path

ALPHABET = list(" \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　​'sStlvedm!?.,019²٣abcdefghijéüñßzqxΣςİıﬁ日本語가😀́ͅa\xad\x00") + [
    "'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "  ", "The", "Ᲊ", "Ɤ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(word_bpe_path())


@pytest.fixture(scope="module")
def counter():
    return token_counts.TokenCounter(word_bpe_path())


def test_counts_equal_the_library(library, counter):
    rng = random.Random(4)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(8000)]
    for text in texts:
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_every_character(library, counter):
    for code in [*range(0xD800), *range(0xE000, 0x30000, 3)]:
        text = f"Ab{chr(code)}1c {chr(code)}"
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), hex(code)


@pytest.mark.parametrize("text", ["a" * 200_000, "ab" * 60_000, "!" * 200_000, " \t\n" * 400_000, "the " * 100_000, "é" * 60_000], ids=["a", "ab", "mark", "space", "the", "accent"])
def test_very_long_texts(library, counter, text):
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_a_vocabulary_that_keeps_white_space():
    from tokenizers import Tokenizer

    path, rng = byte_bpe_path(), random.Random(8)
    library, counter = Tokenizer.from_file(path), token_counts.TokenCounter(path)
    for _ in range(1000):
        text = "".join(rng.choices(ALPHABET, k=rng.randint(0, 40)))
        assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_count_is_symbols_minus_merges(counter):
    """A plain scan for the lowest-ranked pair makes as many merges."""
    m, rng = counter.merges, random.Random(2)
    for _ in range(300):
        word = "".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 14)))
        ids = [m.symbol[c] for c in word[:-1]] + [m.last[word[-1]]]
        while ranked := [(r, i) for i in range(len(ids) - 1) if (r := m.rank.get(ids[i] << 20 | ids[i + 1])) is not None]:
            r, i = min(ranked)
            ids[i : i + 2] = [m.made[r]]
        assert m.count(word) == len(ids)


def test_query(spark, messy_dir, messy_rows, library):
    got = sorted((tuple(r) for r in QUERIES["op13_heap_token_counts"](spark, messy_dir).collect()), key=str)
    want = []
    for i, t in messy_rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 2048))
    assert got == sorted(want, key=str)
