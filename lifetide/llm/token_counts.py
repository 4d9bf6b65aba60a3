"""Token counts by byte-pair merging with a heap over a linked list.

A word starts as one symbol per byte, the last one with the vocabulary's word
end.  A heap holds the adjacent pairs that have a merge, keyed by rank and
place; the lowest is popped and joined, its neighbours' pairs are pushed, and
pairs that changed meanwhile are skipped.  The word's count is its symbols
minus its merges, so no identifiers are emitted, only lengths.

Normalising and splitting into words follow the tokenizer file itself.  Where
the file drops white space (as word-end vocabularies do), a text is cut at
white space and every distinct stretch between is counted once and kept in a
dictionary that is emptied at ``CACHE_ENTRIES``; other files are split whole.

``count`` returns ``doc_id, n_bytes, n_tokens`` for every row, with no shuffle.
A null text is empty (0 bytes, 0 tokens); a null ``doc_id`` and repeated rows
are kept; other columns are ignored whatever their names; an empty table gives
an empty one.  Special strings inside a text count as one token each.  Very
long texts and very long words are counted whole, in n log n steps.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lifetide.llm.bpe import printable_bytes, slices
from lifetide.llm.common import key_and_text

#: Entries each of a task's two dictionaries may hold (about 40 MB).
CACHE_ENTRIES = 300_000
#: Stretches from this many characters on are counted without being kept.
LONG_STRETCH = 200
#: A normaliser that folds white space and case, and a splitter
#: that drops white space, as a tokenizer file states them.
FOLDS = {
    "type": "Sequence",
    "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
}
DROPS_SPACE = {"type": "Split", "behavior": "Removed", "invert": True}
#: Characters whose case, composition or class may differ between Unicode
#: versions, or that ``str.split`` takes for white space and a pattern does not.
UNUSUAL = re.compile("[\x1c-\x1f԰-\U0010ffff]")


class HeapMerges:
    """Number of tokens of a word under a vocabulary file's merges."""

    def __init__(self, spec: dict):
        vocab = spec["model"]["vocab"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        joiner = spec["model"].get("continuing_subword_prefix") or ""
        if joiner or spec["model"].get("byte_fallback") or spec["model"].get("unk_token"):
            raise ValueError("only byte-level vocabularies without prefixes or unknown tokens are supported")
        self.whole = vocab if spec["model"].get("ignore_merges") else {}
        self.symbol = {c: i for c, i in vocab.items() if len(c) == 1}
        self.last = {c: vocab[c + self.end] for c in self.symbol}
        #: left id << 20 | right id -> rank of the merge; rank -> id of the joined token.
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            self.rank[vocab[a] << 20 | vocab[b]] = rank
            self.made.append(vocab[a + b])

    def count(self, word: str) -> int:
        if not word:
            return 0
        if word in self.whole:
            return 1
        symbol, get, made = self.symbol, self.rank.get, self.made
        ids = [symbol[c] for c in word[:-1]]
        ids.append(self.last[word[-1]])
        n = len(ids)
        if n < 2:
            return n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        #: Rank of the pair that starts at each place, -1 if none or merged away.
        pair = [get(a << 20 | b, -1) for a, b in zip(ids, ids[1:])]
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        merges = 0
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if pair[i] != rank:
                continue
            k = after[i]
            ids[i], pair[k], after[i] = made[rank], -1, after[k]
            merges += 1
            right, left = after[i], before[i]
            pair[i] = -1
            if right < n:
                before[right] = i
                pair[i] = r = get(ids[i] << 20 | ids[right], -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | i)
            if left >= 0:
                pair[left] = r = get(ids[left] << 20 | ids[i], -1)
                if r >= 0:
                    heapq.heappush(heap, r << 32 | left)
        return n - merges


class Stretches(dict):
    """Stretch of normalised text without white space -> number of tokens."""

    def __init__(self, counter: TokenCounter):
        super().__init__()
        self.words = counter.words

    def __missing__(self, stretch: str) -> int:
        out = self.words(stretch)
        if len(stretch) < LONG_STRETCH:
            if len(self) >= CACHE_ENTRIES:
                self.clear()
            self[stretch] = out
        return out


class TokenCounter:
    """Counts the tokens of texts under one byte-level ``.json`` file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalise = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str if library.pre_tokenizer else lambda text: [(text, None)]
        self.merges = HeapMerges(spec)
        special = [t["content"] for t in spec["added_tokens"]]
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens that are normalised or stripped are not supported")
        self.special = special
        self.special_cut = re.compile("|".join(re.escape(t) for t in sorted(special, key=len, reverse=True))) if special else None
        first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        self.drops_space = spec["normalizer"] == FOLDS and all(first.get(k) == v for k, v in DROPS_SPACE.items())
        if self.drops_space:
            import regex

            self.find = regex.compile(first["pattern"]["Regex"]).findall
            self.character = {b: c for c, b in printable_bytes().items()}
        self.known_words: dict[str, int] = {}
        self.known = Stretches(self)

    def words(self, stretch: str) -> int:
        """Tokens of a stretch: its words found by the file's own pattern, or by
        its splitter where Unicode versions could differ."""
        known = self.known_words
        if UNUSUAL.search(stretch):
            found = [word for word, _ in self.split(stretch)]
        elif stretch.isascii() and stretch.isprintable():
            found = [stretch] if stretch.isalpha() else self.find(stretch)
        else:
            character = self.character
            found = ["".join([character[b] for b in word.encode()]) for word in self.find(stretch)]
        total = 0
        for word in found:
            n = known.get(word)
            if n is None:
                n = self.merges.count(word)
                if len(word) < LONG_STRETCH:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[word] = n
            total += n
        return total

    def count(self, text: str) -> int:
        if self.special_cut is not None and any(t in text for t in self.special):
            parts = self.special_cut.split(text)
            return len(parts) - 1 + sum(map(self._plain, parts))
        return self._plain(text)

    def _plain(self, text: str) -> int:
        if not text:
            return 0
        if not self.drops_space:
            return sum(self.merges.count(word) for word, _ in self.split(self.normalise(text)))
        if text.isascii() and not UNUSUAL.search(text):
            stretches = text.lower().split()
        elif UNUSUAL.search(text):
            stretches = self.normalise(text).split(" ")
        else:
            # The library lowers each character alone, so a final sigma is as any other.
            import unicodedata

            stretches = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower().split()
        return sum(map(self.known.__getitem__, stretches))


COUNTED = "doc_id long, n_bytes long, n_tokens long"


def count(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row of ``docs``; narrow, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                text = part.column(1)
                n = pa.array([counter.count(t) for t in text.to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), pc.binary_length(text).cast(pa.int64()), n], ["doc_id", "n_bytes", "n_tokens"])

    return key_and_text(docs).mapInArrow(run, COUNTED)
