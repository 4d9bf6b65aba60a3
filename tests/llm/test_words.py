from __future__ import annotations

import random

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lifetide.llm.words import WordReader


def check(texts, column):
    words = WordReader()(column)
    seen = {}
    for i, text in enumerate(texts):
        a, b = words.first[i], words.first[i + 1]
        spans = [text[s:e] for s, e in zip(words.start[a:b], words.end[a:b])]
        want = [w.decode() for w in text.encode().split()]
        assert spans == want
        for h, w in zip(words.hash[a:b].tolist(), want):
            assert seen.setdefault(w.encode().lower(), h) == h
    assert len(set(seen.values())) == len(seen)


@settings(deadline=None)
@given(st.lists(st.text(st.sampled_from("aAbZé東😀 \t\n\x0b\x0c\r\x1c\x85\xa0"))))
def test_words_of_a_batch(texts):
    check(texts, pa.array(texts, pa.string()))


def test_slices_and_long_texts():
    rng = random.Random(1)
    texts = ["", "x " * 100_000, "A" * 100_000] + ["".join(rng.choice("abAB \n") for _ in range(rng.randint(0, 90))) for _ in range(300)]
    for kind in (pa.string(), pa.large_string()):
        check(texts[2:200], pa.array(texts, kind).slice(2, 198))
        check([], pa.array([], kind))
