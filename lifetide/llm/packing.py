"""Packing into windows by minimum bin slack.

Every document's ids end with ``END``.  A document longer than a window fills
whole windows first; what remains (1 to ``window - 1`` ids) goes into a
multiset of lengths.  A window starts with the longest remaining length; a
subset-sum dynamic programme over the multiset, held as one bit per reachable
sum, finds the sum closest to what is left, and backtracking over its steps
gives the count of each length used.  Where the closest sum leaves a gap, the
longest remaining piece is cut to close it.  The last ids of a task, fewer
than a window, are cut into sequences whose lengths are powers of two, which
need no padding.

Each task packs its own rows, ``block_ids`` ids at a time, so memory is
bounded, nothing is shuffled, and the work scales with the input's splits;
between blocks the pieces left over (less than a window) are carried on.
``sequence_id`` holds the partition's number in its upper bits.  On a stored
table a task that runs again makes the same sequences.

Returned per piece: ``doc_id, start, length, ids`` (binary, little-endian
unsigned 32-bit), ``doc_tokens, sequence_id, offset``.  A null text is empty
(one id, ``END``); a null ``doc_id`` is kept; a repeated row is a document of
its own; an empty table gives no pieces; other columns are ignored; very long
texts, also of nothing but white space, are packed whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lifetide.llm.bpe import PRETOKEN, ForcedBoundaryBpe, printable_bytes, slices
from lifetide.llm.common import key_and_text

END = 0
WINDOW = 1024
#: Ids gathered before a block is packed (16 MB).
BLOCK_IDS = 4 << 20
PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


#: ``tiktoken``'s pattern steps back over runs of white space and gives up at
#: some length, so texts that hold a run of so many characters are encoded by
#: ``ForcedBoundaryBpe``, which gives the same ids.
LONG_RUN = 20_000


def library_encoder(path: str):
    """Text -> ids (numpy) with a byte-level vocabulary file, special tokens included."""
    import tiktoken

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    byte = printable_bytes()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    enc = tiktoken.Encoding("vocabulary", pat_str=PRETOKEN, mergeable_ranks=ranks, special_tokens=special)
    other: list[ForcedBoundaryBpe] = []
    run = re.compile(rf"\s{{{LONG_RUN}}}")

    def encode(text: str) -> np.ndarray:
        if len(text) < LONG_RUN or run.search(text) is None:
            return enc.encode_to_numpy(text, allowed_special="all")
        if not other:
            other.append(ForcedBoundaryBpe(path))
        return np.frombuffer(other[0].encode(text), "<u4")

    return encode


def fill(counts: list[int], room: int) -> tuple[int, list[int]]:
    """The reachable sum of the multiset ``counts`` (by length) closest to
    ``room`` from below, and the lengths that make it."""
    bits, steps = 1, []
    target = 1 << room
    mask = (target << 1) - 1
    for length in range(min(room, len(counts) - 1), 0, -1):
        left = min(counts[length], room // length)
        batch = 1
        while left > 0:
            batch = min(batch, left)
            steps.append((length, batch, bits))
            bits |= (bits << length * batch) & mask
            left -= batch
            batch *= 2
        if bits & target:
            break
    total = at = bits.bit_length() - 1
    used: list[int] = []
    for length, batch, before in reversed(steps):
        if not before >> at & 1:
            used += [length] * batch
            at -= length * batch
    return total, used


class Packer:
    def __init__(self, window: int, first_sequence: int):
        self.window, self.next = window, first_sequence
        #: Pieces that remain, by length: (doc_id, start, ids, doc_tokens).
        self.rest: list[list[tuple]] = [[] for _ in range(window)]
        self.counts = [0] * window
        self.rows: list[tuple] = []

    def put(self, piece: tuple) -> None:
        n = len(piece[2])
        if n:
            self.rest[n].append(piece)
            self.counts[n] += 1

    def take(self, length: int) -> tuple:
        self.counts[length] -= 1
        return self.rest[length].pop()

    def close(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), ids.tobytes(), doc_tokens, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        w, n = self.window, len(ids)
        whole = n - n % w
        for at in range(0, whole, w):
            self.close([(doc_id, at, ids[at : at + w], n)])
        self.put((doc_id, whole, ids[whole:], n))

    def pack(self) -> None:
        """Fill windows until the rest makes less than one."""
        w, longest = self.window, self.window - 1
        waiting = sum(n * c for n, c in enumerate(self.counts))
        while waiting >= w:
            while not self.counts[longest]:
                longest -= 1
            window = [self.take(longest)]
            room = w - longest
            filled, lengths = fill(self.counts, room)
            window += [self.take(n) for n in lengths]
            room -= filled
            while room:
                n = max(i for i, c in enumerate(self.counts) if c)
                doc_id, start, ids, doc_tokens = self.take(n)
                cut = min(room, n)
                window.append((doc_id, start, ids[:cut], doc_tokens))
                self.put((doc_id, start + cut, ids[cut:], doc_tokens))
                room -= cut
            self.close(window)
            waiting -= w

    def finish(self) -> None:
        """The last ids, fewer than a window: sequences of powers of two."""
        left = [p for same in reversed(self.rest) for p in same]
        size = 1 << max(0, sum(len(p[2]) for p in left).bit_length() - 1)
        total = sum(len(p[2]) for p in left)
        window: list[tuple] = []
        room = size
        while left:
            doc_id, start, ids, doc_tokens = left.pop(0)
            cut = min(room, len(ids))
            window.append((doc_id, start, ids[:cut], doc_tokens))
            if cut < len(ids):
                left.insert(0, (doc_id, start + cut, ids[cut:], doc_tokens))
            room -= cut
            total -= cut
            if not room:
                self.close(window)
                window, room = [], 1 << max(0, total.bit_length() - 1)

    def out(self) -> list[tuple]:
        rows, self.rows = self.rows, []
        return rows


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Pieces of every row of ``docs`` (``doc_id, text``)."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        names = [c.split()[0] for c in PIECES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer_path)
        packer, held = Packer(window, TaskContext.get().partitionId() << 40), 0
        for batch in batches:
            for part in slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = np.append(encode(text), END).astype("<u4")
                    packer.add(doc_id, ids)
                    held += len(ids)
                if held >= block_ids:
                    packer.pack()
                    held = 0
                if packer.rows:
                    yield batch_of(packer.out())
        packer.pack()
        packer.finish()
        if packer.rows:
            yield batch_of(packer.out())

    return key_and_text(docs).mapInArrow(run, PIECES)
