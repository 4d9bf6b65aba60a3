"""Byte-pair encoding by forced boundaries, and decoding.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be joined by a merge, so it marks a certain cut.  Texts are cut first where a
space precedes a visible character (the pre-tokeniser always cuts there, and
the pairs "visible byte, space" are forced), then every pre-token is cut at
its forced pairs; each fragment is merged alone and the ids are concatenated.
Fragments and the pieces between spaces repeat, so their ids are kept in
dictionaries that are emptied at ``CACHE_ENTRIES``.

Columns: ``encode`` takes ``doc_id, text`` and returns ``doc_id, ids`` (binary,
little-endian unsigned 32-bit); ``decode`` takes ``doc_id, ids`` and returns
``doc_id, text``.  Other input columns are ignored.  A null text is an empty
one (no ids); a null ``doc_id`` and repeated rows are kept as they are; an
empty table gives an empty table.  Very long texts and very long runs of one
character are encoded whole, in n log n steps.  Invalid UTF-8 in decoded bytes
becomes U+FFFD.
"""

from __future__ import annotations

import heapq
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lifetide.llm.common import key_and_text

#: Fixed value: the byte-level pre-tokeniser's pattern.
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries a dictionary of one task may hold (about 80 MB).
CACHE_ENTRIES = 400_000
#: Fragments longer than this many bytes are merged with a heap.
LONG_FRAGMENT = 200


def printable_bytes() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: printable Latin-1
    stands for itself, the other bytes follow from U+0100 in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class SlowPath(Exception):
    """A space is followed by white space: the text needs the careful cut."""


class Pieces(dict):
    """Piece of text -> packed ids; ``lead`` is put before the piece."""

    def __init__(self, encode, lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, piece: str) -> bytes:
        if self.lead and (not piece or piece[0].isspace()):
            raise SlowPath
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        out = self[piece] = self.encode(self.lead + piece)
        return out


class ForcedBoundaryBpe:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = printable_bytes()
        vocab = {bytes(byte[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in byte for c in token)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = added
        self.special_cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(added, key=len, reverse=True)) + ")") if added else None
        self.text_of = {i: token for token, i in vocab.items()} | {i: t.encode() for t, i in added.items()}
        self.byte_id = [vocab[bytes([b])] for b in range(256)]
        #: (left id, right id) -> rank of the merge; rank -> id of the joined token.
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            left, right = bytes(byte[c] for c in a), bytes(byte[c] for c in b)
            self.rank[vocab[left], vocab[right]] = rank
            self.made.append(vocab[left + right])
        inside = bytearray(65536)
        for token in vocab:
            for a, b in zip(token, token[1:]):
                inside[a << 8 | b] = 1
        self.inside = bytes(inside)
        self.find = regex.compile(PRETOKEN).findall
        self.fragments: dict[bytes, bytes] = {}
        self.first, self.spaced = Pieces(self._piece, ""), Pieces(self._piece, " ")

    # -- encoding ---------------------------------------------------------
    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.special_cut is not None and any(t in text for t in self.special):
            parts = self.special_cut.split(text)
            return b"".join(struct.pack("<I", self.special[p]) if p in self.special else self._plain(p) for p in parts if p)
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        head, *rest = text.split(" ")
        try:
            return (self.first[head] if head else b"") + b"".join(map(self.spaced.__getitem__, rest))
        except SlowPath:
            return self._careful(head, rest)

    def _careful(self, head: str, rest: list[str]) -> bytes:
        out, run = [], [head]
        for p in rest:
            if p and not p[0].isspace():
                out.append(self._piece("".join(run)))
                run = [" ", p]
            else:
                run += (" ", p)
        out.append(self._piece("".join(run)))
        return b"".join(out)

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece between certain cuts of the pre-tokeniser."""
        known = self.fragments
        out = []
        for token in self.find(piece):
            raw = token.encode()
            ids = known.get(raw)
            if ids is None:
                ids = b"".join(map(self._fragment, self.cut(raw)))
                if len(raw) < LONG_FRAGMENT:
                    if len(known) >= CACHE_ENTRIES:
                        known.clear()
                    known[raw] = ids
            out.append(ids)
        return b"".join(out)

    def cut(self, raw: bytes) -> list[bytes]:
        """``raw`` cut between the bytes of every forced pair."""
        inside, out, start = self.inside, [], 0
        for i in range(1, len(raw)):
            if not inside[raw[i - 1] << 8 | raw[i]]:
                out.append(raw[start:i])
                start = i
        out.append(raw[start:])
        return out

    def _fragment(self, raw: bytes) -> bytes:
        ids = [self.byte_id[b] for b in raw]
        ids = self._merge_long(ids) if len(ids) > LONG_FRAGMENT else self._merge(ids)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _merge(self, ids: list[int]) -> list[int]:
        """Apply the lowest-ranked merge until none is left."""
        get, none = self.rank.get, len(self.made)
        ranks = [get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) != none:
            i = ranks.index(best)
            ids[i : i + 2] = (self.made[best],)
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list, n log n for long runs."""
        n, get, made = len(ids), self.rank.get, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        #: Rank of the pair that starts at each place, -1 if none or merged away.
        pair = [get(p, -1) for p in zip(ids, ids[1:])]
        pair.append(-1)
        heap = [r << 32 | i for i, r in enumerate(pair) if r >= 0]
        heapq.heapify(heap)
        while heap:
            entry = heapq.heappop(heap)
            rank, i = entry >> 32, entry & 0xFFFFFFFF
            if pair[i] != rank:
                continue
            k = after[i]
            ids[i], ids[k], pair[k], after[i] = made[rank], -1, -1, after[k]
            if after[i] < n:
                before[after[i]] = i
            pair[i] = -1
            for left, right in ((i, after[i]), (before[i], i)):
                if left >= 0 and right < n:
                    pair[left] = r = get((ids[left], ids[right]), -1)
                    if r >= 0:
                        heapq.heappush(heap, r << 32 | left)
        return [x for x in ids if x >= 0]

    # -- decoding ---------------------------------------------------------
    def decode(self, packed: bytes) -> str:
        table = self.text_of
        raw = b"".join([table.get(i, b"") for i in np.frombuffer(packed, "<u4").tolist()])
        return raw.decode("utf-8", "replace")


ENCODED = "doc_id long, ids binary"


def encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, ids`` of every row of ``docs``; narrow, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                ids = pa.array([bpe.encode(t) for t in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return key_and_text(docs).mapInArrow(run, ENCODED)


def round_trip(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, ids, text`` with the text decoded from ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ForcedBoundaryBpe(tokenizer_path)
        for batch in batches:
            for part in slices(batch):
                text = pa.array([bpe.decode(i or b"") for i in part.column(1).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, text], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id, text`` from ``doc_id, ids``."""
    return round_trip(encoded, tokenizer_path).select("doc_id", "text")


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Short slices, so the Python copies of long texts stay few."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
