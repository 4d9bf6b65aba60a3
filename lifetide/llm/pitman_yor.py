"""Language-model scores from a hierarchical Pitman-Yor model.

Tokens are words (lower-case A-Z) and one end per text.  A token's context is
the word before it, or the text's start; each has a restaurant of its own.  The
``CONTEXTS - 2`` most frequent words and the start have numbers, and arrays hold
their totals; all other contexts are rows, known by their words' hashes.  (With
``most``, a parameter of ``train``, so many have a restaurant and all other
words share one.)  Every restaurant's parent is the root
restaurant over words, whose base is uniform over the training vocabulary and
one unknown word.  A customer is a training token; seating follows the Chinese
restaurant process with discount and strength, and each table of a context
restaurant is a customer of the root.

Gibbs: a sweep takes the customers of a word in a context away and seats them
anew, all at once, given all others: the number of their tables is drawn
exactly from its distribution (generalised Stirling numbers times the odds of
each further table in the context's restaurant and the root).  A word's
contexts take turns, then its customers in the root are seated in the same way.
There are ``TURNS`` turns at most: a word with more contexts seats several in
one turn, each given the state before the turn.  Totals over words (tables per
restaurant) are those of the sweep before.  Above ``LARGEST`` customers the
distribution's saddle point and spread stand for it.
Sweeps are Spark jobs over the stored pairs of word and context, sorted by
word; pairs with one customer have one table whatever is drawn, so a sweep reads
only their number by word.  After a sweep, the tables of contexts without a
number go to their pairs by a join.  Random numbers come from a hash of word, context, sweep and step, so a sweep
gives the same seating wherever and whenever it runs, and a task works earlier
sweeps out again from the totals instead of storing seats.  The
first ``BURN_IN`` sweeps are dropped; predictive probabilities are averaged
over the others.  Discounts come from the counts of counts, n1 / (n1 + 2 n2).

Scoring: the probabilities of the most frequent pairs of context and word
(``HEAD`` at most, 24 bytes each: 48 MB) are broadcast; all other tokens are
sorted by word together with the stored model and read beside it, half of the
words at a time.  What training has not seen in a context without a number is
then sorted by context beside those contexts' weights; a context that it has not
seen at all gives the root's probability.  All ways
give the same value.  A word is known by its 64-bit hash.

``train`` takes ``docs (doc_id, text)``; ``score`` returns per row ``doc_id,
n_tokens, n_known, base_score, score`` (log10).  A null text is empty (one
token, the end); null ids and repeated rows are kept; a very long text is
scored whole; without training rows every word is unknown; an empty table
gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifetide.llm.bpe import slices
from lifetide.llm.common import brief_shuffles, discard, key_and_text, likely, stored
from lifetide.llm.words import WordReader

CONTEXTS = 1 << 14
OTHER, START = 0, 1
END = np.uint64(0x9E3779B97F4A7C40)
#: Pairs of context and word whose probabilities are broadcast.
HEAD = 1 << 21
STRENGTH = 1.0
BURN_IN, SAMPLES = 1, 2
#: Customers of a word in a restaurant up to which seats are drawn exactly.
LARGEST = 256
#: Tokens gathered before equal ones are added up (16 MB).
GATHER = 2 << 20
#: Pairs of word and context that are seated at a time (some 50 MB).
PAIRS = 1 << 19
#: Turns that the contexts of a word take in a sweep.
TURNS = 64
#: In the table that ``score`` sorts: a text's own row, a word of the model,
#: or the tokens of a word.
TEXT, WORD, TOKENS = 0, 1, 2
#: Parts of the words (a power of two) that are sorted one after another, so that half of the pairs and tokens are on disk at a time.
SLICES = 2


def tokens(texts: pa.Array, read: WordReader) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and ends of all ``texts``, and where each text's
    tokens begin (and the last ones end)."""
    words = read(texts, places=False)
    first = words.first + np.arange(len(words.first))
    out = np.empty(first[-1], np.uint64)
    out[np.arange(len(words.hash)) + np.repeat(np.arange(len(texts)), np.diff(words.first))] = words.hash
    out[first[1:] - 1] = END
    return out, first


def contexts(found: np.ndarray, first: np.ndarray, frequent: np.ndarray, own: bool = False) -> np.ndarray:
    """The tokens' contexts.  ``frequent``: the hashes of the context words that
    have numbers, in ascending order.  ``own``: other words stand for themselves
    by their hashes, not all for one context."""
    out = np.full(len(found), OTHER, np.int64)
    if own:
        out[1:] = found[:-1].view(np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found[:-1]), len(frequent) - 1)
        out[1:] = np.where(frequent[at] == found[:-1], at + 2, out[1:])
    out[first[:-1]] = START
    return out


def paired(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """64 bits that stand for a word in a context."""
    return word.view(np.uint64) ^ (context.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    if not len(columns[0]):
        return np.empty(0, np.int64)
    return np.flatnonzero(np.r_[True, np.any([x[1:] != x[:-1] for x in columns], axis=0)])


def counted(docs: DataFrame, frequent: np.ndarray | None, own: bool = False) -> DataFrame:
    """``w, u, n``: counts of words in contexts, or (without ``frequent``) of
    words without the ends, added up within about ``GATHER`` tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = WordReader()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def gathered() -> pa.RecordBatch:
            w, u = (np.concatenate(x) for x in zip(*held))
            key = paired(w, u)
            order = np.argsort(key)
            first = changes(key[order])
            n = np.diff(np.r_[first, len(key)])
            some = order[first]
            return pa.RecordBatch.from_arrays([pa.array(w[some].view(np.int64)), pa.array(u[some]), pa.array(n)], ["w", "u", "n"])

        for batch in batches:
            for part in slices(batch, 256):
                found, first = tokens(part.column(1), read)
                if frequent is None:
                    found = found[found != END]
                    held.append((found, np.zeros(len(found), np.int64)))
                else:
                    held.append((found, contexts(found, first, frequent, own)))
                size += len(found)
                if size >= GATHER:
                    yield gathered()
                    held, size = [], 0
        if held:
            yield gathered()

    return key_and_text(docs).mapInArrow(run, "w long, u long, n long")


def numbered(u: str, size: int) -> str:
    """Whether ``u`` is a context with a number, whose totals are arrays."""
    return f"({u} >= 0 AND {u} < {size})"


def slice_of_words(k: int) -> str:
    return f"(w & {SLICES - 1}) = {k}"


def pair_table(docs: DataFrame, frequent: np.ndarray, own: bool) -> DataFrame:
    """``w, u, n, c, t``: the counts of words in contexts; of a context without
    a number also its customers and its words.  Such a context is rare, so all of
    its rows meet in one task; pairs with other contexts are dealt out singly."""
    size = len(frequent) + 2

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for u, w, n in whole_groups(batches):
            first = changes(u, w)
            n, w, u = np.add.reduceat(n, first), w[first], u[first]
            group = changes(u)
            t = np.diff(np.r_[group, len(u)])
            rare = (u < 0) | (u >= size)
            c, t = (np.where(rare, np.repeat(x, t), 0) for x in (np.add.reduceat(n, group), t))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (w, u, n, c, t)], ["w", "u", "n", "c", "t"])

    key = F.expr(f"CASE WHEN {numbered('u', size)} THEN xxhash64(w, u) ELSE u END")
    dealt = counted(docs, frequent, own).select("u", "w", "n").repartition(key).sortWithinPartitions("u", "w")
    return stored(dealt.mapInArrow(merge, "w long, u long, n long, c long, t long"), "word-pairs")


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of about ``PAIRS`` rows at a time, sorted by the first column, whose values are not parted."""
    held: list[list[np.ndarray]] = []
    size, least = 0, PAIRS
    for batch in batches:
        if batch.num_rows:
            held.append([x.to_numpy() for x in batch.columns])
            size += batch.num_rows
        if size >= least:
            now = [np.concatenate(x) for x in zip(*held)]
            last = int(np.searchsorted(now[0], now[0][-1]))
            if last:
                yield [x[:last] for x in now]
            held, size = [[x[last:] for x in now]], len(now[0]) - last
            least = max(PAIRS, 2 * size)
    if size:
        yield [np.concatenate(x) for x in zip(*held)]


# -- seating ---------------------------------------------------------------
def random_bits(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    x = key ^ np.uint64((sweep * 0x9E3779B97F4A7C15 + step * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def uniform(key: np.ndarray, sweep: int, step: int) -> np.ndarray:
    return ((random_bits(key, sweep, step) >> np.uint64(11)) + 0.5) * 2.0**-53


def seatings(discount: float, largest: int = LARGEST) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers: [c, t] is the weight of
    all ways to seat c customers at t tables."""
    out = np.full((largest + 1, largest + 1), -np.inf)
    out[0, 0] = 0
    t = np.arange(largest + 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        for c in range(largest):
            stay = np.where((t > 0) & (t <= c), out[c] + np.log(c - discount * t), -np.inf)
            out[c + 1] = np.logaddexp(stay, np.r_[-np.inf, out[c, :-1]])
    return out


def many_tables(c: np.ndarray, odds, before: np.ndarray, discount: float, key: np.ndarray, sweep: int) -> np.ndarray:
    """As ``drawn``, for more than ``LARGEST`` customers: the saddle point of
    the same distribution and the spread around it, or, where tables are few,
    one large table and a Poisson number of others."""
    t = before
    for _ in range(4):  # the odds of a table at the number of tables that they give
        a = odds(t)
        low, high = np.full(len(c), -690.0), np.zeros(len(c))
        for _ in range(50):
            q = (low + high) / 2
            more = np.log1p(-np.exp(np.minimum(q, -1e-12))) + (discount - 1) * q > np.log(c / a)
            low, high = np.where(more, q, low), np.where(more, high, q)
        q = np.exp(high)
        t = np.clip(a * (1 - q**discount) / discount, 1, c)
    spread = np.maximum(t - c / (1 + (1 - discount) * (1 - q) / q), 0)
    u, v = uniform(key, sweep, 1), uniform(key, sweep, 2)
    out = np.floor(t + np.sqrt(spread) * np.sqrt(-2 * np.log(u)) * np.cos(2 * np.pi * v) + 0.5)
    few = np.flatnonzero(t < 16)
    if len(few):
        mean = a[few] * (1 - c[few] ** -discount) / discount
        p = total = np.exp(-mean)
        out[few] = 1
        for j in range(1, 100):
            out[few] += total < u[few]
            p = p * mean / j
            total = total + p
    return np.clip(out, 1, c)


def drawn(c: np.ndarray, odds, table: np.ndarray, key: np.ndarray, sweep: int) -> np.ndarray:
    """The number of tables of each of ``c`` (2 to ``LARGEST``) customers, drawn
    exactly from its distribution given all other customers: a seating's weight
    times, for each table, ``odds(rows, j)`` with j tables before it."""
    out = np.ones(len(c))
    u = uniform(key, sweep, 0)
    width = 2
    while width < 2 * LARGEST:
        rows = np.flatnonzero((c > width // 2) & (c <= width) & (c > 1))
        step = (1 << 20) // width
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            size = int(c[some].max())
            logs = table[c[some], 1 : size + 1] + np.cumsum(np.log(odds(some, np.arange(size)[None, :])), axis=1)
            p = np.cumsum(np.exp(logs - logs.max(axis=1, keepdims=True)), axis=1)
            out[some] += (p < u[some, None] * p[:, -1:]).sum(axis=1)
        width *= 2
    return out


@dataclass(frozen=True)
class Totals:
    """Over all words after a sweep: tables by context with a number, all
    tables of contexts (the root's customers), and the root's tables."""

    tables: np.ndarray
    all_tables: float
    root_tables: float


@dataclass(frozen=True)
class Settings:
    tokens: int
    words: int
    customers: np.ndarray
    discount: float
    root_discount: float

    @property
    def base(self) -> float:
        return 1 / (self.words + 1)

    def root_new(self, t: Totals) -> float:
        return (STRENGTH + self.root_discount * t.root_tables) * self.base

    def root_probability(self, customers: np.ndarray, tables: np.ndarray, t: Totals) -> np.ndarray:
        return (customers - self.root_discount * tables + self.root_new(t)) / (STRENGTH + t.all_tables)

    def fallback(self, t: Totals) -> np.ndarray:
        """Weight of the root's probability in each context."""
        return (STRENGTH + self.discount * t.tables) / (STRENGTH + self.customers)


class Words:
    """Words of a sorted table, their pairs flat, and the sweeps over them.
    Columns: w, u, n and the tables of u, if it has no number, after each sweep
    so far; a row with n of 0 or less stands for -n contexts that have the word
    once, which have a table each whatever is drawn."""

    def __init__(self, columns: list[np.ndarray], size: int, weights: dict[float, np.ndarray]):
        self.weights = weights
        w, u, n, *rare = columns
        first = changes(w)
        of = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(w)]))
        self.word = w[first]
        self.single = np.bincount(of, np.maximum(-n, 0), len(first))
        pairs = n > 0
        self.of, self.context, self.n = of[pairs], u[pairs], n[pairs]
        self.rare = [x[pairs] for x in rare]
        self.near = (self.context >= 0) & (self.context < size)
        self.slot = np.where(self.near, self.context, 0)
        self.key = paired(self.word[self.of], self.context)

    def by_word(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.of, values, len(self.word))

    def tables_of(self, sweep: int, t: Totals) -> np.ndarray:
        """The tables of each pair's context after a sweep."""
        return np.where(self.near, t.tables[self.slot], self.rare[sweep]) if self.rare else t.tables[self.slot]

    def sweeps(self, settings: Settings, totals: list[Totals]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(tables, root customers, root tables) after each sweep that ``totals`` allows."""
        d, e = settings.discount, settings.root_discount
        for x in {d, e} - set(self.weights):
            self.weights[x] = seatings(x)
        weights, root_weights = self.weights[d], self.weights[e]
        tables = np.ones(len(self.n))  # at first every pair has one table
        customers = self.single + self.by_word(tables)
        root = np.ones(len(self.word))
        large = np.flatnonzero(self.n > LARGEST)
        some = np.flatnonzero((self.n > 1) & (self.n <= LARGEST))
        # A word's contexts take turns: its first pair, then its second, and so on.
        turn = (np.arange(len(some)) - np.searchsorted(self.of[some], self.of[some])) % TURNS
        by_turn = np.argsort(turn, kind="stable")
        turns = np.split(some[by_turn], np.flatnonzero(np.diff(turn[by_turn])) + 1) if len(some) else []
        for sweep, t in enumerate(totals, 1):
            tables = tables.copy()
            all_root, new, of_context = t.all_tables, settings.root_new(t), self.tables_of(sweep - 1, t)

            def pair_odds(rows: np.ndarray):
                """Odds of j more tables once the rows' own customers are gone."""
                mine, of = tables[rows], self.of[rows]
                here = STRENGTH + d * np.maximum(of_context[rows] - mine, 0)
                others = customers[of] - mine
                parent = np.where(others > 0, np.maximum(others - e * np.minimum(root[of], others), 0), 0) + new
                total = STRENGTH + np.maximum(all_root - mine, 0)
                return lambda at, j: (here[at] + d * j) * (parent[at] + j) / (total[at] + j)

            if len(large):
                odds = pair_odds(large)
                tables[large] = many_tables(self.n[large].astype(float), lambda j: odds(slice(None), j), tables[large], d, self.key[large], sweep)
                customers = self.single + self.by_word(tables)
            for rows in turns:
                odds = pair_odds(rows)
                found = drawn(self.n[rows], lambda at, j: odds(at[:, None], j), weights, self.key[rows], sweep)
                customers += np.bincount(self.of[rows], found - tables[rows], len(customers))
                tables[rows] = found
            gone = np.maximum(t.root_tables - root, 0)
            key, root = self.word.view(np.uint64), np.ones(len(self.word))

            def root_odds(at, j):
                return (STRENGTH + e * (gone[at] + j)) * settings.base

            up = np.flatnonzero(customers > LARGEST)
            if len(up):
                root[up] = many_tables(customers[up], lambda j: root_odds(up, j), root[up], e, key[up], -sweep)
            up = np.flatnonzero((customers > 1) & (customers <= LARGEST))
            root[up] = drawn(customers[up].astype(np.int64), lambda at, j: root_odds(up[at][:, None], j), root_weights, key[up], -sweep)
            yield tables, customers.copy(), root


SWEPT = "slot int, u long, x double"


def swept(seats: DataFrame, settings: Settings, totals: list[Totals], size: int) -> DataFrame:
    """The tables over one a pair after a sweep: by context with a number
    (``slot``), or by ``u`` (``slot`` -1).  Then all of them, and the root's tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[float, np.ndarray] = {}
        total = np.zeros(size + 2)
        for columns in whole_groups(batches):
            w = Words(columns, size, weights)
            *_, (tables, _, root) = w.sweeps(settings, totals)
            more = tables - 1
            total += np.r_[np.bincount(w.slot[w.near], more[w.near], size), more.sum(), root.sum()]
            u = np.flatnonzero(~w.near & (more > 0))
            if len(u):
                columns = [np.full(len(u), -1, np.int32), w.context[u], more[u]]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["slot", "u", "x"])
        some = np.flatnonzero(total)
        columns = [some.astype(np.int32), np.zeros(len(some), np.int64), total[some]]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["slot", "u", "x"])

    dealt = seats.repartition("w").sortWithinPartitions("w", "u")
    return stored(dealt.mapInArrow(run, SWEPT), "swept")


MODEL = "w long, c long, p1 array<double>, context array<long>, n array<long>, a array<float>"


@dataclass(frozen=True)
class Model:
    """``words``: stored ``w, c, p1 (by sample), context, n, a``; n customers of
    a word in a context give the part a of its probability there, which is all of
    it where the context has no number.  ``rare``: stored ``u, f``, the weight of
    the root's probability (by sample) in such contexts; None if they share one."""

    words: DataFrame
    rare: DataFrame | None
    frequent: np.ndarray
    settings: Settings
    fallback: np.ndarray
    unknown: np.ndarray

    @property
    def weight(self):
        """The weight of the root's probability besides ``a``, by context and sample: none where ``a`` is all."""
        fallback = self.fallback
        size = fallback.shape[1]

        def weights(context: np.ndarray) -> np.ndarray:
            near = (context >= 0) & (context < size)
            return np.where(near, fallback[:, np.where(near, context, 0)], 0).T

        return weights


def train(docs: DataFrame, most: int | None = None) -> Model:
    """From every row of ``docs``, with a restaurant for every context or (with
    ``most``) at most so many below the root, of which the rare contexts share one."""
    own = most is None
    with brief_shuffles(docs.sparkSession):
        top = counted(docs, None).groupBy("w").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "w").limit((CONTEXTS if own else most) - 2).select("w").toArrow()
    frequent = np.sort(top.column(0).to_numpy().view(np.uint64))
    size = len(frequent) + 2
    last = BURN_IN + SAMPLES
    with brief_shuffles(docs.sparkSession):
        pairs = pair_table(docs, frequent, own)
        near = pairs.where(numbered("u", size)).groupBy("u").agg(F.sum("n").alias("n"), F.count("*").alias("t")).toArrow()
        customers, types = np.zeros(size), np.zeros(size)
        for x, name in ((customers, "n"), (types, "t")):
            x[near.column("u").to_numpy()] = near.column(name).to_numpy()
        words = stored(pairs.groupBy("w").agg(F.sum("n").alias("c"), F.sum(F.expr("int(n = 1)")).alias("once")), "words")
        sums = words.selectExpr("sum(c)", "count(1)", "sum(int(c = 1))", "sum(int(c = 2))", "sum(once)").first()
        n_tokens, n_words, one_word, two_word, one = (x or 0 for x in sums)
        n_pairs, two = (x or 0 for x in pairs.selectExpr("count(1)", "sum(int(n = 2))").first())

        def discount(ones: float, twos: float) -> float:
            return float(np.clip(ones / (ones + 2 * twos) if ones else 0.5, 0.05, 0.95))

        settings = Settings(int(n_tokens), int(n_words), customers, discount(one, two), discount(one_word, two_word))
        totals = [Totals(types, float(n_pairs), float(n_words))]
        # Pairs that are seen once have one table each: a sweep reads only their number by word.
        known = [f"t{k}" for k in range(last + 1)]
        fixed = pairs.where(f"n > 1 AND {numbered('u', size)}").select("w", "u", "n").unionByName(words.selectExpr("w", "0L AS u", "-once AS n"))
        rare = pairs.where(f"NOT {numbered('u', size)}")
        all_more = []
        open_rare = stored(rare.where("n > 1").select("w", "u", "n", F.col("t").alias("t0")), "seats")
        for sweep in range(1, last + 1):
            seats = open_rare.unionByName(fixed.selectExpr("*", *(f"0L AS {x}" for x in known[:sweep])))
            found = swept(seats, settings, list(totals), size)
            x = np.zeros(size + 2)
            for row in found.where("slot >= 0").groupBy("slot").agg(F.sum("x")).collect():
                x[row[0]] = row[1]
            totals.append(Totals(types + x[:size], n_pairs + x[size], x[size + 1]))
            # The tables of the other contexts go to their pairs that have more than one customer.
            more = stored(found.where("slot < 0").groupBy("u").agg(F.sum("x").cast("long").alias("more")), "more-tables", drop=found)
            all_more.append(more)
            if sweep < last:
                moved = open_rare.join(more, "u", "left").withColumn(known[sweep], F.expr("t0 + coalesce(more, 0L)"))
                open_rare = stored(moved.select(*open_rare.columns, known[sweep]), "seats", drop=open_rare)
        discard(open_rare)
        discard(words)
        # Most contexts without a number have one table a pair after each sweep.
        each = [x.selectExpr("u", *(f"{'more' if k == i else '0L'} AS m{k}" for k in range(1, last + 1))) for i, x in enumerate(all_more, 1)]
        moved = reduce(DataFrame.unionByName, each).groupBy("u").agg(*(F.sum(f"m{k}").alias(f"m{k}") for k in range(1, last + 1)))
        moved = stored(moved, "moved")
        for x in all_more:
            discard(x)

        def after(table: DataFrame) -> DataFrame:
            """``table`` (``u, t``) with the tables of its contexts after each sweep."""
            return table.join(moved, "u", "left").selectExpr("*", "t AS t0", *(f"t + coalesce(m{k}, 0L) AS t{k}" for k in range(1, last + 1)))

        sampled = totals[1 + BURN_IN :]

        def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights: dict[float, np.ndarray] = {}
            for word, u, n, c, *rare in whole_groups(batches):
                w = Words([word, u, n, *rare], size, weights)
                states = list(w.sweeps(settings, totals[:-1]))[BURN_IN:]
                p1 = np.stack([settings.root_probability(x, r, t) for (_, x, r), t in zip(states, sampled)], axis=1)
                at = STRENGTH + np.where(w.near, customers[w.slot], c)
                a = sum(n - settings.discount * tables for tables, _, _ in states) / len(states) / at
                weight = np.stack([STRENGTH + settings.discount * x for x in rare[1 + BURN_IN :]], axis=1) / at[:, None]
                a += np.where(w.near, 0, (weight * p1[w.of]).mean(axis=1))
                first = changes(word)
                offsets = pa.array(np.r_[first, len(word)].astype(np.int32))
                samples = pa.array(np.arange(0, p1.size + 1, p1.shape[1], dtype=np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (u, n, a.astype(np.float32))]
                columns = [pa.array(w.word), pa.array(np.add.reduceat(n, first)), pa.ListArray.from_arrays(samples, pa.array(p1.ravel())), *lists]
                yield pa.RecordBatch.from_arrays(columns, ["w", "c", "p1", "context", "n", "a"])

        every = pairs.where(numbered("u", size)).unionByName(likely(rare, moved, "u", met=False))
        every = every.selectExpr("w", "u", "n", "c", *(f"t AS {x}" for x in known))
        every = every.unionByName(after(likely(rare, moved, "u")).select("w", "u", "n", "c", *known))
        parts = [every.where(slice_of_words(k)).repartition("w").sortWithinPartitions("w", "u") for k in range(SLICES)]
        predicted = reduce(DataFrame.unionByName, [stored(x.mapInArrow(final, MODEL), "model") for x in parts])
        contexts = None
        if own:
            weight = [f"({STRENGTH}D + {settings.discount!r}D * {x}) / ({STRENGTH}D + c)" for x in known[1 + BURN_IN :]]
            found = after(rare.groupBy("u").agg(F.max("c").alias("c"), F.max("t").alias("t")))
            contexts = stored(found.selectExpr("u", f"array({', '.join(weight)}) AS f"), "weights")
        discard(pairs)
        discard(moved)
    fallback = np.stack([settings.fallback(t) for t in sampled])
    unknown = np.array([settings.root_new(t) / (STRENGTH + t.all_tables) for t in sampled])
    return Model(predicted, contexts, frequent, settings, fallback, unknown)


def steps(n: np.ndarray) -> np.ndarray:
    """Counts in steps of a sixteenth of a power of two."""
    return np.floor(np.log2(n) * 16).astype(np.int64)


def head_step(model: Model, limit: int) -> int:
    """The least step such that at most ``limit`` pairs are in it or above."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1024, np.int64)
        for batch in batches:
            total += np.bincount(steps(batch.column(0).flatten().to_numpy()), minlength=1024)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["step", "pairs"])

    found = model.words.select("n").mapInArrow(run, "step long, pairs long").groupBy("step").agg(F.sum("pairs").alias("pairs"))
    total, least = 0, 1024
    for r in sorted(found.collect(), key=lambda r: -r["step"]):
        total += r["pairs"]
        if total > limit:
            break
        least = r["step"]
    return least


def flat(batch: pa.RecordBatch, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The row of every entry of a batch's lists, and the lists' entries."""
    lists = [batch.column(name) for name in names]
    return np.repeat(np.arange(len(batch)), lists[0].value_lengths().to_numpy()), [x.flatten().to_numpy() for x in lists]


def frequent_pairs(model: Model, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``limit`` pairs of context and word in ascending order, the log10
    of their probabilities, and the words' counts."""
    least, weight = head_step(model, limit), model.weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, (context, n, a) = flat(batch, ("context", "n", "a"))
            some = np.flatnonzero(steps(n) >= least)
            of, context, a = of[some], context[some], a[some]
            p1 = batch.column("p1").flatten().to_numpy().reshape(len(batch), -1)[of]
            logs = np.log10(a + (p1 * weight(context)).mean(axis=1))
            key = paired(batch.column("w").to_numpy()[of], context).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(logs), pa.array(batch.column("c").to_numpy()[of])], ["key", "logs", "c"])

    key, logs, c = (x.to_numpy() for x in model.words.mapInArrow(run, "key long, logs double, c long").toArrow().columns)
    key = key.view(np.uint64)
    order = np.argsort(key)
    return key[order], logs[order], c[order]


BESIDE = (
    "w long, kind int, row long, n long, doc_id long, x array<double>, context array<long>, a array<float>, texts array<long>, times array<int>"
)
SUMS = "row long, doc_id long, n_tokens long, n_known long, base_score double, score double"
#: A token that training has not seen in its context, which has no number: the context, how often, the word's probabilities in the root.
OPEN = "u long, times int, x array<double>"


def score(docs: DataFrame, model: Model, head: int = HEAD) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` of every row of
    ``docs``, a stored table (rows are numbered in its order, which a task that
    runs again finds unchanged)."""
    settings, frequent, weight, unknown, own = model.settings, model.frequent, model.weight, model.unknown, model.rare is not None
    denominator = settings.tokens + 0.1 * (settings.words + 1)
    types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32()}
    types |= {f"array<{name}>": pa.list_(kind) for name, kind in types.items()}
    schema = pa.schema([(name, types[kind]) for name, kind in map(str.split, BESIDE.split(", "))])
    sent = docs.sparkSession.sparkContext.broadcast(frequent_pairs(model, head))

    def base(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / denominator)

    def beside_row(rows: int, /, **columns: pa.Array) -> pa.RecordBatch:
        """Rows of ``BESIDE``, null but for ``columns``."""
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(rows, f.type)) for f in schema], schema=schema)

    def lists(first: np.ndarray, values: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[first, len(values)].astype(np.int32)), pa.array(values))

    def run(batches: Iterator[pa.RecordBatch], part_of_words: int) -> Iterator[pa.RecordBatch]:
        """A row per text with the sums over its frequent pairs (with the first
        part of the words), and all other tokens by word, gathered over many texts."""
        pairs, logs, counts = sent.value
        plain = base(counts)
        read = WordReader()
        row = TaskContext.get().partitionId() << 40
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0

        def gathered() -> pa.RecordBatch:
            w, u, text, times = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(w)
            first = changes(w[order])
            n = len(first)
            return beside_row(
                n,
                w=pa.array(w[order[first]].view(np.int64)),
                kind=pa.array(np.full(n, TOKENS, np.int32)),
                context=lists(first, u[order]),
                texts=lists(first, text[order]),
                times=lists(first, times[order]),
            )

        for batch in batches:
            for part in slices(batch, 256):
                found, first = tokens(part.column(1), read)
                n, sizes = part.num_rows, np.diff(first)
                context, doc = contexts(found, first, frequent, own), np.repeat(np.arange(n), sizes)
                key = paired(found, context)
                order = np.argsort(key, kind="stable")  # a pair's texts stay in order
                key, doc = key[order], doc[order]
                common = np.zeros(len(key), bool)
                sums = np.zeros((n, 3))
                if len(pairs):
                    at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
                    common = pairs[at] == key
                    at, mine = at[common], doc[common]
                    if not part_of_words:
                        sums = np.stack([np.bincount(mine, x, n) for x in (None, plain[at], logs[at])], axis=1).astype(float)
                rows = row + np.arange(n)
                # A text's own row gets a key by its number, so such rows are spread evenly.
                if not part_of_words:
                    yield beside_row(
                        n,
                        w=pa.array(random_bits(rows.astype(np.uint64), 0, 0).view(np.int64)),
                        kind=pa.array(np.full(n, TEXT, np.int32)),
                        row=pa.array(rows),
                        n=pa.array(sizes),
                        doc_id=part.column(0),
                        x=lists(np.arange(n) * 3, sums.ravel()),
                    )
                rest = ~common & (found[order] & np.uint64(SLICES - 1) == part_of_words)
                key, doc, order = key[rest], doc[rest], order[rest]
                one = changes(key, doc)
                some = order[one]
                held.append((found[some], context[some], row + doc[one], np.diff(np.r_[one, len(key)]).astype(np.int32)))
                waiting += len(one)
                if waiting >= GATHER // 4:
                    yield gathered()
                    held, waiting = [], 0
                row += n
        if waiting:
            yield gathered()

    def beside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial sums of the texts, from tokens sorted by word behind their
        word of the model."""
        word = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, len(unknown)))
        pairs, parts, of = np.empty(0, np.uint64), np.empty(0, np.float32), np.empty(0, np.int64)

        held: list[tuple[np.ndarray, ...]] = []

        def by_text() -> pa.RecordBatch:
            row, *sums = (np.concatenate(x) for x in zip(*held))
            some, of = np.unique(row, return_inverse=True)
            known, plain, logs = (np.bincount(of, x, len(some)) for x in sums)
            return partial(some, pa.nulls(len(some), pa.int64()), np.zeros(len(some), np.int64), known.astype(np.int64), plain, logs)

        def partial(row, doc_id, n, known, plain, logs, u=None, times=None, x=None) -> pa.RecordBatch:
            names = ["row", "doc_id", "n_tokens", "n_known", "base_score", "score", "u", "times", "x"]
            nulls = [pa.nulls(len(row), kind) for kind in (pa.int64(), pa.int32(), pa.list_(pa.float64()))]
            rest = [none if y is None else y for none, y in zip(nulls, (u, times, x))]
            return pa.RecordBatch.from_arrays([pa.array(y) for y in (row, doc_id, n, known, plain, logs, *rest)], names)

        for batch in batches:
            kind = batch.column("kind").to_numpy()
            texts, model_words, rest = (batch.take(pa.array(np.flatnonzero(kind == x))) for x in (TEXT, WORD, TOKENS))
            if len(texts):
                x = texts.column("x").flatten().to_numpy().reshape(-1, 3)
                yield partial(texts.column("row"), texts.column("doc_id"), texts.column("n"), x[:, 0].astype(np.int64), x[:, 1], x[:, 2])
            if len(model_words):
                # The words of this batch, and the last one before it, which may go on here.
                kept, mine = len(word[0][-1:]), of == len(word[0]) - 1
                p1 = model_words.column("x").flatten().to_numpy().reshape(len(model_words), -1)
                now = model_words.column("w").to_numpy(), model_words.column("n").to_numpy(), p1
                word = tuple(np.concatenate([old[-1:], new]) for old, new in zip(word, now))
                found, (u, a) = flat(model_words, ("context", "a"))
                of, pairs, parts = np.r_[np.zeros(mine.sum(), np.int64), found + kept], np.r_[pairs[mine], paired(now[0][found], u)], np.r_[parts[mine], a]
                order = np.argsort(pairs)
                of, pairs, parts = of[order], pairs[order], parts[order]
            if not len(rest):
                continue
            at, (u, text, times) = flat(rest, ("context", "texts", "times"))
            w = rest.column("w").to_numpy()[at]
            c, p1, a = np.zeros(len(w), np.int64), np.tile(unknown, (len(w), 1)), np.zeros(len(w))
            if len(word[0]):
                at = np.minimum(np.searchsorted(word[0], w), len(word[0]) - 1)
                known = word[0][at] == w
                c[known], p1[known] = word[1][at[known]], word[2][at[known]]
                wanted = paired(w, u)
                at = np.minimum(np.searchsorted(pairs, wanted), len(pairs) - 1)
                seen = known & (pairs[at] == wanted)
                a[seen] = parts[at[seen]]
            p = a + (p1 * weight(u)).mean(axis=1)
            done = p > 0
            logs = times * np.log10(np.where(done, p, 1))
            held.append((text, times * (c > 0), times * base(c), logs))
            if sum(len(x[0]) for x in held) >= GATHER:
                yield by_text()
                held = []
            if not done.all():
                text, u, times, p1 = text[~done], u[~done], times[~done], p1[~done]
                none = np.zeros(len(u))
                yield partial(text, pa.nulls(len(u), pa.int64()), none.astype(np.int64), none.astype(np.int64), none, none, u, times, lists(np.arange(len(u)) * p1.shape[1], p1.ravel()))
        if held:
            yield by_text()

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The logarithms that ``beside`` left open, from tokens sorted by context behind its weights."""
        context, f = np.empty(0, np.int64), np.empty((0, len(unknown)))
        for batch in batches:
            kind, u = batch.column("kind").to_numpy(), batch.column("u").to_numpy()
            x = batch.column("x").flatten().to_numpy().reshape(len(batch), -1)
            new = kind == 0
            if new.any():
                context, f = np.r_[context[-1:], u[new]], np.concatenate([f[-1:], x[new]])
            if new.all():
                continue
            u, x, weights = u[~new], x[~new], np.ones((int((~new).sum()), len(unknown)))  # a context that training has not seen is the root
            if len(context):
                at = np.minimum(np.searchsorted(context, u), len(context) - 1)
                weights = np.where((context[at] == u)[:, None], f[at], 1)
            logs = batch.column("times").to_numpy()[~new] * np.log10((weights * x).mean(axis=1))
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("row").to_numpy()[~new]), pa.array(logs)], ["row", "score"])

    columns = [f.split()[0] for f in SUMS.split(", ")]
    words = model.words.selectExpr("w", f"{WORD} AS kind", "-1L AS row", "c AS n", "p1 AS x", "context", "a")
    done = []
    with brief_shuffles(docs.sparkSession):
        for k in range(SLICES):
            parts = key_and_text(docs).mapInArrow(lambda batches, k=k: run(batches, k), BESIDE)
            dealt = words.where(slice_of_words(k)).unionByName(parts, allowMissingColumns=True).repartition("w").sortWithinPartitions("w", "kind")
            done.append(stored(dealt.mapInArrow(beside, f"{SUMS}, {OPEN}"), "sums"))
    sums = reduce(DataFrame.unionByName, done)
    if own:
        left = sums.where("u IS NOT NULL").selectExpr("u", "1 AS kind", "row", "times", "x")
        left = model.rare.selectExpr("u", "0 AS kind", "0L AS row", "0 AS times", "f AS x").unionByName(left)
        left = left.repartition("u").sortWithinPartitions("u", "kind").mapInArrow(resolve, "row long, score double")
        sums = sums.where("u IS NULL").select(*columns).unionByName(left, allowMissingColumns=True)
    return (
        sums.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")))
        .drop("row")
    )
