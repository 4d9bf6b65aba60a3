"""Quality rules as a learned decision list, in DataFrame functions alone.

``measure`` computes every text's statistics, ``learn`` grows the list by
sequential covering from labelled statistics, and ``verdict`` turns it into
one ordered conditional expression.

Learning: a rule is a conjunction of thresholds.  It grows on two thirds of
the labelled rows by the span of one feature (one threshold or two) with the
best FOIL gain, out of all spans between ``CUTS`` quantiles of the bad rows and
of all rows that it still covers; the span's ends are then moved between finer
and finer quantiles around them as long as the gain rises.  A step is an
aggregation (counts by feature, bin and label); nothing else reaches the
driver.  It grows until no span has a gain, however many conditions that are.
On the other third its last conditions are pruned where that raises
``(p - n) / (p + n)``.  A rule is taken if its precision there reaches
``precision`` within a standard error, and the rows it covers leave; if not, the bad rows it covers
start no further rule, but rules for other kinds of bad rows are still grown.
Covering ends when bad rows that start a rule are fewer than ``support``, or
when a rule does not raise the precision on the pruning rows at all.
``precision`` and ``support`` (bad rows that a span must cover) are the only
limits.

Words in windows that repeat: every 3-word window's 64-bit hash is sorted
together with its position, which brings equal windows side by side.

A null text has no words; null ids and repeated rows are measured like
others; labels that are null, neither 0 nor 1, or without a document are
ignored, and without any the list is empty and keeps everything; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import discard, key_and_text, stored

SPACES = r"[\x20\x09-\x0D]+"
#: Fixed value: the symbols of the contract.
SYMBOLS = "#*$%&|<>"
CUTS = 24
#: Precision on the pruning rows that a rule needs, and bad rows that a span covers at least.
PRECISION, SUPPORT = 0.9, 5
#: Labelled rows of one task at least.
TASK_ROWS = 100_000

FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "capital_share": "n_capitals / greatest(word_chars, 1)",
    "mark_share": "n_marks / greatest(word_chars, 1)",
    "repeated_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_word_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct / greatest(n_words, 1)",
}


def without(characters: str) -> Column:
    return F.length("text") - F.length(F.translate("text", characters, ""))


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of every row."""
    spaces = " \t\n\x0b\x0c\r"
    base = key_and_text(docs).select(
        "doc_id",
        F.split(F.trim("text", F.lit(spaces)), SPACES).alias("w"),
        F.length(F.translate("text", spaces, "")).alias("word_chars"),
        without(SYMBOLS).alias("n_symbols"),
        without("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_capitals"),
        without("!?").alias("n_marks"),
        F.filter(F.split("text", "\n"), lambda line: F.length(F.trim(line, F.lit(spaces))) > 0).alias("lines"),
    )
    counted = base.select(
        "*",
        F.when(F.col("word_chars") > 0, F.size("w")).otherwise(0).alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
    )
    hashed = counted.withColumn(
        "h", F.expr("CASE WHEN n_words >= 3 THEN transform(sequence(0, n_words - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2])) ELSE array() END")
    ).drop("w", "lines")
    paired = hashed.withColumn(
        "s", F.expr("CASE WHEN size(array_distinct(h)) < size(h) THEN sort_array(transform(h, (x, i) -> struct(x AS x, i AS i))) ELSE array() END")
    ).drop("h")
    at = paired.withColumn(
        "p", F.expr("sort_array(transform(filter(s, (e, j) -> e.x = get(s, j - 1).x OR e.x = get(s, j + 1).x), e -> e.i))")
    )
    covered_words = "CASE WHEN size(p) = 0 THEN 0 ELSE 3 + aggregate(transform(p, (x, j) -> CASE WHEN j = 0 THEN 0 ELSE least(3, x - p[j - 1]) END), 0, (n, x) -> n + x) END"
    numbers = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_capitals", "n_marks", "n_lines", "n_distinct"]
    return at.select("doc_id", *[F.col(c).cast("long").alias(c) for c in numbers], F.expr(covered_words).cast("long").alias("n_repeat_words"))


def features(measured: DataFrame) -> list[Column]:
    return [F.expr(f"cast({e} AS double)").alias(f"f_{name}") for name, e in FEATURES.items()]


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def sql(self, expression: str | None = None) -> str:
        return f"({expression or 'f_' + self.feature}) {'>' if self.above else '<='} {self.cut!r}D"


Rule = tuple[Condition, ...]


def rule_sql(rule: Rule, raw: bool = False) -> str:
    return " AND ".join(c.sql(FEATURES[c.feature] if raw else None) for c in rule)


Counts = dict[tuple[str, int, int], int]
#: A feature's span: over the first cut and up to the second; None is open.
Span = tuple[str, float | None, float | None]


def cut_points(rows: DataFrame, parts: list[tuple[str, str]]) -> list[list[float]]:
    """For each (feature, SQL condition): quantiles of the feature over the bad
    rows and over all of ``rows`` that the condition holds for."""
    points = ", ".join(repr(i / (CUTS + 1)) for i in range(1, CUTS + 1))
    found = rows.agg(
        *[
            F.expr(f"percentile_approx(f_{name}, array({points}), 1000) FILTER (WHERE {among} AND {which})").alias(f"q{k}_{i}")
            for k, (name, among) in enumerate(parts)
            for i, which in enumerate(("label = 0", "true"))
        ]
    ).first()
    return [sorted({*(found[f"q{k}_0"] or ()), *(found[f"q{k}_1"] or ())}) for k in range(len(parts))]


def every_cut(rows: DataFrame) -> dict[str, list[float]]:
    return dict(zip(FEATURES, cut_points(rows, [(name, "true") for name in FEATURES])))


def bin_sql(value: str, points: list[float]) -> str:
    """How many of the sorted ``points`` are under ``value``, by halving steps;
    the points are one literal, so steps with other points run the same code."""
    if not points:
        return "0"
    known = f"cast(split('{','.join(map(repr, points))}', ',') AS array<double>)"
    steps = ", ".join(str(1 << i) for i in range(len(points).bit_length() - 1, -1, -1))
    return f"aggregate(array({steps}), 0, (p, s) -> CASE WHEN get({known}, p + s - 1) < {value} THEN p + s ELSE p END)"


def binned(rows: DataFrame, cuts: dict[str, list[float]]) -> Counts:
    """Rows by feature, bin (the cuts that the value exceeds) and label."""
    bins = [F.struct(F.lit(name).alias("feature"), F.expr(bin_sql(f"f_{name}", points)).alias("bin")) for name, points in cuts.items()]
    found = rows.select("label", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin", "label").count().collect()
    return {(r["feature"], r["bin"], r["label"]): r["count"] for r in found}


def foil_gain(p: int, n: int, bad: int, good: int, support: int) -> float:
    """Bits saved for the ``p`` bad rows of a part of (``bad``, ``good``) rows."""
    if p < support or p + n == bad + good:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(bad / (bad + good)))


def best_span(rows: DataFrame, cuts: dict[str, list[float]], bad: int, good: int, support: int) -> tuple[float, Span, int, int]:
    """The span between two cuts with the best FOIL gain: the gain, the span,
    and the bad and good rows in it."""
    counts = binned(rows, cuts)
    best: tuple[float, Span, int, int] = (1e-9, ("", None, None), 0, 0)
    for name, points in cuts.items():
        ends: list[float | None] = [None, *points, None]
        for i in range(len(points) + 1):
            p = n = 0
            for j in range(i, len(points) + 1):
                p, n = p + counts.get((name, j, 0), 0), n + counts.get((name, j, 1), 0)
                gain = foil_gain(p, n, bad, good, support)
                if gain > best[0]:
                    best = (gain, (name, ends[i], ends[j + 1]), p, n)
    return best


def refined(rows: DataFrame, found: tuple[float, Span, int, int], cuts: list[float], bad: int, good: int, support: int) -> tuple[float, Span, int, int]:
    """``found`` with its ends moved between finer cuts around them, as long as
    the gain rises."""
    while True:
        name, low, high = found[1]
        reach = []
        for end in (low, high):
            if end is not None:
                i = cuts.index(end)
                reach.append((cuts[i - 1] if i else -math.inf, cuts[i + 1] if i + 1 < len(cuts) else math.inf))
        x = f"f_{name}"
        sides = [" AND ".join([f"{x} > {a!r}D"] * (a > -math.inf) + [f"{x} <= {b!r}D"] * (b < math.inf)) or "true" for a, b in reach]
        finer = cut_points(rows, [(name, side) for side in sides])
        cuts = sorted({*(c for points in finer for c in points), *(end for end in (low, high) if end is not None)})
        better = best_span(rows, {name: cuts}, bad, good, support)
        if better[0] <= found[0] + 1e-9:
            return found
        found = better


def conditions(span: Span) -> Rule:
    name, low, high = span
    return tuple(Condition(name, above, cut) for above, cut in ((True, low), (False, high)) if cut is not None)


def grown(rows: DataFrame, bad: int, good: int, support: int) -> Rule:
    """A rule for bad ``rows``: spans are added until none has a gain."""
    rule: Rule = ()
    while bad >= support and good:
        cuts = every_cut(rows)
        found = best_span(rows, cuts, bad, good, support)
        if not found[1][0]:
            break
        _, span, bad, good = refined(rows, found, cuts[found[1][0]], bad, good, support)
        rule += conditions(span)
        rows = rows.where(rule_sql(conditions(span)))
    return rule


def covered(rows: DataFrame, rules: list[Rule]) -> list[tuple[int, int]]:
    """(bad, good) rows that each rule covers."""
    sums = [
        F.sum(F.expr(f"CASE WHEN label = {label} AND {rule_sql(rule) or 'true'} THEN 1 ELSE 0 END")).alias(f"c{i}_{label}")
        for i, rule in enumerate(rules)
        for label in (0, 1)
    ]
    row = rows.agg(*sums).first()
    return [(row[f"c{i}_0"] or 0, row[f"c{i}_1"] or 0) for i in range(len(rules))]


def learn(measured: DataFrame, labels: DataFrame, precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """The ordered rules that reject, from ``labels (doc_id, quality)``."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label")).where("label IN (0, 1)")
    rows = measured.select("doc_id", *features(measured)).join(marked, "doc_id")
    rows = stored(rows.withColumn("prune", F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).drop("doc_id"), "labelled")
    # Labelled rows are few to a file, and every step reads them.
    left = seeds = rows.coalesce(max(1, rows.count() // TASK_ROWS))
    rules: list[Rule] = []
    while True:
        grow, prune = seeds.where("NOT prune"), left.where("prune")
        [(bad, good)] = covered(grow, [()])
        rule = grown(grow, bad, good, support)
        if not rule:
            break
        shorter = [rule[:i] for i in range(len(rule) + 1)]
        (all_bad, all_good), *counts = covered(prune, shorter)
        worth = [((p - n) / (p + n) if p + n else -1.0, p, n, r) for (p, n), r in zip(counts, shorter[1:])]
        _, p, n, rule = max(worth, key=lambda w: (w[0], -len(w[3])))
        if p and p / (p + n) >= precision - math.sqrt(precision * (1 - precision) / (p + n)):
            rules.append(rule)
            left, seeds = left.where(f"NOT ({rule_sql(rule)})"), seeds.where(f"NOT ({rule_sql(rule)})")
        elif p and p / (p + n) > all_bad / (all_bad + all_good):
            seeds = seeds.where(f"label = 1 OR NOT ({rule_sql(rule)})")
        else:
            break
    discard(rows)
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule (from 1) that rejects a measured row; null if none does."""
    if not rules:
        return F.lit(None).cast("int")
    return F.expr("CASE " + " ".join(f"WHEN {rule_sql(r, raw=True)} THEN {i}" for i, r in enumerate(rules, 1)) + " END")
