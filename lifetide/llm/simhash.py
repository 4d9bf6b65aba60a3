"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprint: lower-case A-Z, words are runs of bytes outside 0x20 and
0x09-0x0D, every ``shingle`` consecutive words (repeats included, joined by
one space; fewer words: the whole sequence) give a 64-bit XXH64 with seed 42;
a bit is 1 if it is set in over half of them.  No words: fingerprint 0.

Links: fingerprints at ``max_bits`` or fewer differing bits.  Equal
fingerprints are one node.  Two linked fingerprints agree on at least
``BLOCKS - max_bits`` of ``BLOCKS`` bit blocks, so each fingerprint is sent to
one group for every choice of that many blocks.  A group is searched with a
Gray-order index: fingerprints sorted by their rank in the reflected binary
code are cut into leaves; a leaf keeps the bits that all its members share
(mask and pattern), an upper node the bits shared by its leaves.  A search
adds the differing shared bits on the way down and drops a whole node once
the sum passes ``max_bits``.  A group over ``SMALL`` emits a spanning forest of
its links, never all pairs.  A group over ``GROUP_LIMIT`` is cut into parts by a
hash and every pair of parts is searched as a group of its own, so no task
holds more than two parts at once and no link is lost.  (Such groups come from
dense clusters; the fingerprints within a few bits of each other are bounded
by the number of bit patterns, whatever the number of documents.)

Components are found on the fingerprints by alternating large-star and
small-star steps, each written to the shared folder.

Columns: ``fingerprints`` returns ``doc_id, fp`` (long) for every row;
``components`` adds ``component_id``, the smallest ``doc_id`` reachable.  A
null text has no words; a null ``doc_id`` is kept and does not count as the
smallest (a component of null ids alone has a null id); repeated rows stay;
an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.bpe import slices
from lifetide.llm.common import discard, key_and_text, stored

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: Bit blocks; with at most 4 differing bits two of six agree: 15 keys of 21
#: bits.  From some 10^8 documents on, eight blocks (70 keys of 32 bits) keep
#: the groups small; the links are the same for any number over ``max_bits``.
BLOCKS = 6
#: Fingerprints of a group, or of one part of it, that are searched at once.
GROUP_LIMIT = 4096
#: Groups up to this size are compared row against row.
SMALL = 16
#: Fingerprints in a leaf, and leaves in an upper node, of the index.
LEAF, FAN = 32, 16


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Every ``size`` consecutive words joined by a space; fewer words: all of them."""
    if not words:
        return []
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= size:
        return [line]
    starts = [0, *(ends[: len(words) - size] + 1).tolist()]
    return [line[a:b] for a, b in zip(starts, ends[size - 1 :].tolist())]


def fingerprint(text: str, size: int = SHINGLE) -> int:
    import xxhash

    parts = shingles(text.encode().lower().split(), size)
    if not parts:
        return 0
    digest = xxhash.xxh64_digest
    raw = np.frombuffer(b"".join([digest(p, SEED) for p in parts]), np.uint8).reshape(-1, 8)
    # Bits are summed over short runs so that the unpacked bits stay small.
    ones = sum(np.unpackbits(raw[i : i + 4096], axis=1).sum(axis=0, dtype=np.int64) for i in range(0, len(raw), 4096))
    return int.from_bytes(np.packbits(2 * ones > len(parts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every row; narrow, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                fp = np.array([fingerprint(t, shingle) for t in part.column(1).to_pylist()], np.uint64).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp)], ["doc_id", "fp"])

    return key_and_text(docs).mapInArrow(run, "doc_id long, fp long")


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected binary code."""
    rank = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def shared_bits(values: np.ndarray, masks: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mask and pattern of the bits that every run of ``width`` entries shares."""
    at = np.arange(0, len(values), width)
    ones = np.bitwise_and.reduceat(values & masks, at)
    zeros = np.bitwise_and.reduceat(~values & masks, at)
    return ones | zeros, ones


class GrayIndex:
    """Two levels of shared bit patterns above fingerprints in Gray order."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        full = np.full(len(fps), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.leaf_mask, self.leaf_bits = shared_bits(self.fps, full, LEAF)
        self.top_mask, self.top_bits = shared_bits(self.leaf_bits, self.leaf_mask, FAN)
        self.leaf_top = np.arange(len(self.leaf_bits)) // FAN

    def near(self, query: np.uint64, max_bits: int, open_leaf: np.ndarray) -> np.ndarray:
        """Positions within ``max_bits`` of ``query``, in leaves still open."""
        above = np.bitwise_count((query ^ self.top_bits) & self.top_mask)
        leaves = np.flatnonzero((above <= max_bits)[self.leaf_top] & open_leaf)
        if not len(leaves):
            return leaves
        # What the upper node counted is kept; only bits that it leaves open are added.
        top = self.leaf_top[leaves]
        more = np.bitwise_count((query ^ self.leaf_bits[leaves]) & self.leaf_mask[leaves] & ~self.top_mask[top])
        leaves = leaves[above[top] + more <= max_bits]
        at = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
        at = at[at < len(self.fps)]
        return at[np.bitwise_count(self.fps[at] ^ query) <= max_bits]


def spanning_links(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest of its linked set) for all but the smallest, over
    the links among ``fps`` (distinct): a search from each newly reached
    fingerprint among those not yet reached."""
    index = GrayIndex(fps)
    fps = index.fps
    waiting = np.ones(len(fps), bool)
    left = np.add.reduceat(waiting.astype(np.int64), np.arange(0, len(fps), LEAF))
    out: list[tuple[int, int]] = []
    for seed in range(len(fps)):
        if not waiting[seed]:
            continue
        waiting[seed] = False
        left[seed // LEAF] -= 1
        members, queue = [seed], [seed]
        while queue:
            found = index.near(fps[queue.pop()], max_bits, left > 0)
            found = found[waiting[found]]
            waiting[found] = False
            np.subtract.at(left, found // LEAF, 1)
            members += found.tolist()
            queue += found.tolist()
        if len(members) > 1:
            signed = fps[members].astype(np.int64)
            low = int(signed.min())
            out += [(int(x), low) for x in signed if x != low]
    return out


def block_masks(blocks: int, agree: int) -> list[int]:
    """A mask for every choice of ``agree`` of ``blocks`` runs of the 64 bits."""
    edge = [round(64 * i / blocks) for i in range(blocks + 1)]
    runs = [((1 << (b - a)) - 1) << a for a, b in zip(edge, edge[1:])]
    signed = lambda m: m - (1 << 64) if m >> 63 else m
    return [signed(sum(chosen)) for chosen in combinations(runs, agree)]


def links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, limit: int = GROUP_LIMIT) -> DataFrame:
    """Spanning links ``(a, b)`` among distinct fingerprints ``fp``: every
    group's linked sets as stars."""
    if blocks <= max_bits:
        raise ValueError("blocks must exceed max_bits")
    masks = block_masks(blocks, blocks - max_bits)
    keyed = nodes.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"))
    sizes = keyed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored before the join: one straight on the aggregation's partitions could not be split.
    keyed = keyed.join(stored(sizes, "sizes"), ["mask", "key"])

    # A group within the limit is one cell.  A larger one is cut into parts by
    # a hash; a row goes to the cell of its part with every part.
    parts = F.ceil(F.col("n") / F.lit(limit)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    cells = keyed.withColumn("parts", parts).withColumn("own", own).select(
        "mask", "key", "fp", F.explode(F.expr("transform(sequence(0, parts - 1), o -> struct(least(own, o), greatest(own, o)))")).alias("pair")
    ).select(F.xxhash64("mask", "key", "pair").alias("cell"), "fp")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy()])
            last = int(np.searchsorted(cell, cell[-1])) if len(cell) else 0
            if last:  # the last cell may go on in the next batch
                yield star_batch(cell[:last], fps[:last], max_bits)
                cell, fps = cell[last:], fps[last:]
        if len(cell):
            yield star_batch(cell, fps, max_bits)

    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(search, "a long, b long")


def star_batch(cell: np.ndarray, fps: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links of whole cells (sorted by cell): small ones all at once, row
    against row, larger ones each through an index."""
    start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
    size = np.diff(np.r_[start, len(cell)])
    small = np.repeat(size <= SMALL, size)
    bits = fps.view(np.uint64)
    ends_a, ends_b = [], []
    for shift in range(1, SMALL):
        if shift >= len(cell):
            break
        near = (cell[shift:] == cell[:-shift]) & small[shift:] & (np.bitwise_count(bits[shift:] ^ bits[:-shift]) <= max_bits)
        ends_a.append(fps[shift:][near])
        ends_b.append(fps[:-shift][near])
    for at, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        found = np.array(spanning_links(np.unique(bits[at : at + n]), max_bits), np.int64).reshape(-1, 2)
        ends_a.append(found[:, 0])
        ends_b.append(found[:, 1])
    columns = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64)) for x in (ends_a, ends_b)]
    return pa.RecordBatch.from_arrays(columns, ["a", "b"])


def connected(edges: DataFrame, steps: int = 64) -> DataFrame:
    """``(node, root)`` with the smallest node reachable, for every node of
    ``edges (a, b)``, by alternating large-star and small-star steps until
    nothing changes (their number grows with the logarithm of the nodes).  The
    result reads a stored table, which the caller may ``discard``."""
    pairs = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = summary(pairs)
    for _ in range(steps):
        both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are stored before their joins, so that the many links of one node can be split.
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "low")
        # Large star: every larger neighbour of a node is tied to the node's minimum.
        large = both.where("b > a").join(low, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), "large", drop=low)
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        low = stored(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "n"), "low")
        tied = F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        small = large.join(low, F.col("a") == F.col("n")).select(F.inline(tied)).where("a <> b").distinct()
        pairs = stored(small, "star", drop=pairs)
        discard(low)
        discard(large)
        before, state = state, summary(pairs)
        if state == before:
            settled = pairs.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
            settled.stored_path = pairs.stored_path
            return settled
    raise RuntimeError(f"components not settled after {steps} steps")


def summary(pairs: DataFrame) -> tuple:
    """Count and hash sum of a set of pairs: equal for equal sets."""
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())


def components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, blocks: int = BLOCKS) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = connected(links(nodes.select("fp"), max_bits, blocks))
    rooted = stored(
        nodes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root")), "roots"
    )
    discard(roots)
    # Stored before the join, so that the many fingerprints of one root can be split.
    lowest = stored(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "lowest")
    named = stored(rooted.join(lowest, "root").select("fp", "component_id"), "named", drop=rooted)
    discard(lowest)
    return stored(prints.join(named, "fp").select("doc_id", "fp", "component_id"), "components", drop=prints)
