"""Secrets by keyword prefilter, anchored patterns and embedded checksums.

An Aho-Corasick automaton over the text in lower-case A-Z finds every
keyword; a pattern is tried only where its keyword starts, in order and never
inside the match before it, which gives the pattern's leftmost
non-overlapping matches.  Long hexadecimal runs have no keyword and are found
as runs of their alphabet.  Tokens that carry a checksum count only if it
holds.

Kinds, in this order: ``assign`` (keyword, sign, value of 8 characters or
more), ``access`` (AKIA key id, 16 or more), ``hex`` (32 or more), ``github``
and ``npm`` (prefix, 30 characters, CRC-32 of those in 6 base-62 digits).

``scan`` returns ``doc_id, spans`` with ``spans`` an array of
``(kind, start, end)`` in code points, by start and then kind; ``redact``
replaces spans (merged where they overlap) in ``text`` and keeps all other
columns as they are.  A null text is empty for ``scan`` and stays null in
``redact``; a null ``doc_id`` and repeated rows are kept; an empty table gives
an empty one; ``scan`` ignores other columns.  Both are narrow: each row is
judged alone, with no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lifetide.llm.bpe import slices
from lifetide.llm.common import key_and_text

# The patterns, keywords and lengths of the contract.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "github", "npm")
# Public prefixes of tokens with an embedded CRC-32.
PREFIXES = {"github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), "npm": ("npm_",)}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
REDACTED = "[REDACTED]"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits."""
    n, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = BASE62[digit] + out
    return out


class Scanner:
    def __init__(self):
        import ahocorasick

        self.words = ahocorasick.Automaton()
        for w in ASSIGN_WORDS:
            self.words.add_word(w, ("assign", len(w)))
        self.words.add_word("akia", ("access", 4))
        for kind, prefixes in PREFIXES.items():
            for w in prefixes:
                self.words.add_word(w, (kind, len(w)))
        self.words.make_automaton()
        self.pattern = {
            "assign": re.compile(ASSIGN, re.ASCII | re.IGNORECASE),
            "access": re.compile(ACCESS),
            "github": re.compile(r"gh[pousr]_[0-9A-Za-z]+"),
            "npm": re.compile(r"npm_[0-9A-Za-z]+"),
        }
        self.hex = re.compile(HEX)

    def holds(self, kind: str, m: re.Match) -> bool:
        if kind == "assign":
            return len(m[2]) >= 8
        if kind == "access":
            return len(m[0]) >= 16
        body = m[0][4:]
        return len(body) == 36 and checksum62(body[:30]) == body[30:]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        if not text:
            return []
        lower = text.encode().lower().decode()  # A-Z alone, so offsets stay
        out, done = [], dict.fromkeys(KINDS, 0)
        hits = sorted((end + 1 - n, kind) for end, (kind, n) in self.words.iter(lower))
        for start, kind in hits:
            if start >= done[kind] and (m := self.pattern[kind].match(text, start)):
                done[kind] = m.end()
                if self.holds(kind, m):
                    out.append((kind, start, m.end()))
        out += [("hex", m.start(), m.end()) for m in self.hex.finditer(text)]
        return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))

    def redacted(self, text: str) -> str:
        out, at = [], 0
        for _, start, end in self.spans(text):
            if start >= at:
                out += [text[at:start], REDACTED]
            at = max(at, end)
        return "".join([*out, text[at:]])


SPANS = "array<struct<kind:string,start:long,end:long>>"


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans`` of every row."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for part in slices(batch):
                found = [[dict(zip(("kind", "start", "end"), s)) for s in scanner.spans(t)] for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return key_and_text(docs).mapInArrow(run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by ``REDACTED``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for part in slices(batch):
                clean = [t if t is None else scanner.redacted(t) for t in part.column(at).to_pylist()]
                columns = [*part.columns]
                columns[at] = pa.array(clean, pa.string())
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    return docs.mapInArrow(run, docs.schema)
