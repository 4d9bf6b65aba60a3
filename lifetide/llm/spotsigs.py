"""SpotSigs document fingerprints, in DataFrame functions alone.

Words are runs of letters and digits in lower case.  A signature is a chain of
two content words (words outside ``COMMON``) that starts right after a common
word; the text's start and every ``STRETCH`` content words without a common
word start one too, so texts without common words have signatures.  A
fingerprint is the sorted set of the signatures' 64-bit hashes, all of them.
A text with fewer than two content words has one signature, the hash of its
words (of the text itself where there are none); an empty text has none.

``similar`` links all fingerprints of a table at a Jaccard similarity: equal
sets are one class; sets are partitioned by length so that one can only meet
its own and the next partition; in them it is found through its rarest
signatures (as many as two similar sets cannot all miss, rarest by the counts
over the whole table), and pairs whose lengths rule them out are pruned before
the sets are compared.  A signature in a third of all texts is among the
rarest of almost none; the joins are ones whose hot keys adaptive execution
splits.

Likeness is the Jaccard similarity of two sets; two empty sets are alike (1).

Neighbours: a document's next one (by ``doc_id``, null ids first, ties by the
text, or, where one id has rows for several ranges, by a hash of the text and
then the text; after the last the first) is found without
a global sort.  Ids are cut into ranges of about ``RANGE_ROWS`` documents at
their quantiles, so ids far off make no large range; where one id, or the null
one, holds several ranges, its rows are dealt to them by the hash.  A range's
first document is also sent to the range before, and a window per range reads
the next row; texts are shuffled once.  The bounds and the ranges' first ids
(at most ``MAX_RANGES``) are what is broadcast.

A null text is empty; repeated rows are documents of their own (only rows with
one id and one text stay in one range); an empty table gives an empty one;
other columns are ignored.  Signatures are made in time linear in the text,
however long its runs of common words are.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lifetide.llm.common import key_and_text, stored

#: Common words of English, French, German and Spanish.
COMMON = """
a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was we were which with you
au aux avec ce ces dans de des du elle en est et il la le les leur mais ne nous ou par pas pour que qui sa se son sur un une vous
als am auch auf aus bei das dem den der des die ein eine einen einer es für ich im ist mit nach nicht sie sich sind und vom von war wie zu zum zur
al como con del el ella era es eran esta este fue las lo los más no para pero por si sin su sus también una uno y ya
""".split()
STRETCH = 4
RANGE_ROWS = 256
MAX_RANGES = 1 << 16
_MARK = "\x01"


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of ``text`` (never null)."""
    words = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")
    padded = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    common = "|".join(sorted(set(COMMON), key=lambda w: (-len(w), w)))
    longest = max(map(len, COMMON))
    marked = F.regexp_replace(padded, f" (?=[^ ]{{1,{longest}}} )(?:{common})(?= )", f" {_MARK}")
    marked = F.regexp_replace(marked, f"(?: [^ {_MARK}]++){{{STRETCH}}}(?= )", f"$0 {_MARK}")
    # A content word after one or more marks carries one; the first always does.
    # A run of marks is read once, from its first: the other places fail at once.
    run = f"(?<!{_MARK})(?: {_MARK})++"
    joined = F.regexp_replace(F.concat(F.lit(f" {_MARK}"), marked), f"{run} (?=[^ {_MARK}])", f" {_MARK}")
    content = F.trim(F.regexp_replace(joined, f"{run} *$", ""))
    return F.struct(F.split(content, " ").alias("t"), F.split(F.translate(content, _MARK, ""), " ").alias("s"), words.alias("w"), text.alias("x"))


def chains(parts: str) -> Column:
    """Signature hashes from the column made by ``signatures``."""
    return F.expr(f"""
      CASE WHEN {parts}.x = '' THEN cast(array() AS array<bigint>)
           WHEN size({parts}.s) < 2 THEN array(xxhash64(CASE WHEN trim({parts}.w) = '' THEN {parts}.x ELSE trim({parts}.w) END))
           ELSE sort_array(array_distinct(transform(
             filter(sequence(0, size({parts}.s) - 2), i -> startswith({parts}.t[i], '{_MARK}')),
             i -> xxhash64({parts}.s[i], {parts}.s[i + 1])))) END""")


def with_signatures(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the signature hashes of the column ``text`` as ``out``."""
    return df.withColumn("_parts", signatures(F.col(text))).withColumn(out, chains("_parts")).drop("_parts")


def fingerprint(sigs: str) -> Column:
    """The set as one string."""
    return F.array_join(F.col(sigs).cast("array<string>"), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets."""
    return F.expr(f"""
      CASE WHEN size({a}) = 0 AND size({b}) = 0 THEN 1.0D
           WHEN size({a}) = 0 OR size({b}) = 0 THEN 0.0D
           ELSE size(array_intersect({a}, {b})) / cast(size({a}) + size({b}) - size(array_intersect({a}, {b})) AS double) END""")


def _below(bounds: list[int], value: str, least: bool) -> str:
    """How many of the sorted ``bounds`` are under ``value`` (``least``) or
    under or equal to it, by halving steps (SQL text)."""
    if not bounds:
        return "0"
    # A literal of its own, made from text once when the plan is optimised.
    known = f"cast(split('{','.join(map(str, bounds))}', ',') AS array<bigint>)"
    steps = ", ".join(str(1 << i) for i in range(len(bounds).bit_length() - 1, -1, -1))
    fits = "<" if least else "<="
    return f"aggregate(array({steps}), 0, (p, s) -> CASE WHEN p + s <= {len(bounds)} AND get({known}, p + s - 1) {fits} {value} THEN p + s ELSE p END)"


def ranges(docs: DataFrame) -> tuple[Column, bool]:
    """The number of each row's range, which grows with ``doc_id`` and the hash
    of the text, and whether any id has several."""
    size = docs.agg(F.count("doc_id").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    wanted = min(MAX_RANGES, size["n"] // RANGE_ROWS)
    nameless = max(1, min(MAX_RANGES, -(-(size["rows"] - size["n"]) // RANGE_ROWS)))
    bounds: list[int] = []
    if wanted > 1:
        shares = ", ".join(repr(i / wanted) for i in range(1, wanted))
        bounds = docs.agg(F.expr(f"percentile_approx(doc_id, array({shares}), {4 * wanted})")).first()[0]
    spread = "((xxhash64(text) / 18446744073709551616.0D) + 0.5D)"
    under, upto = _below(bounds, "doc_id", True), _below(bounds, "doc_id", False)
    shared = len(set(bounds)) < len(bounds)
    # The ranges of an id that is several bounds are those after the bound before it.
    named = f"CASE WHEN {upto} - {under} < 2 THEN {upto} ELSE {under} + least({upto} - {under}, 1 + cast(floor({spread} * ({upto} - {under})) AS int)) END" if shared else upto
    lost = f"least({nameless - 1}, cast(floor({spread} * {nameless}) AS int))" if nameless > 1 else "0"
    return F.expr(f"CASE WHEN doc_id IS NULL THEN {lost} ELSE {nameless} + {named} END"), shared or nameless > 1


def with_next(docs: DataFrame, columns: list[str], add: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next document for ``columns``.
    Columns made by ``add`` are made after the shuffle, so they do not travel."""
    own, tied = ranges(docs)
    tie = F.xxhash64("text") if tied else F.lit(0).cast("long")
    firsts = docs.select(own.alias("_range"), F.struct("doc_id", tie.alias("tie")).alias("_at")).groupBy("_range").agg(F.min("_at").alias("_first"))
    # Stored: the ends and the order of the ranges are read from it.
    firsts = stored(firsts, "ranges")
    ends = firsts.agg(F.max("_range")).first()[0]
    before = firsts.select("_first", F.coalesce(F.lag("_range").over(Window.orderBy("_range")), F.lit(ends)).alias("_before"))
    place = F.array(F.struct(own.alias("_range"), F.lit(False).alias("_guest")))
    guest = F.array(F.struct(F.col("_before").alias("_range"), F.lit(True).alias("_guest")))
    here = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (tie == F.col("_first.tie"))
    sent = docs.join(F.broadcast(before), here, "left").select(
        *docs.columns, F.inline(F.when(F.col("_before").isNull(), place).otherwise(F.concat(place, guest)))
    )
    dealt = add(sent.repartition("_range"))
    line = Window.partitionBy("_range").orderBy("_guest", "doc_id", *([F.xxhash64("text")] if tied else []), "text")
    paired = dealt.withColumn("_next", F.lead(F.struct(*columns)).over(line)).where("NOT _guest")
    kept = [c for c in paired.columns if c not in ("_range", "_guest", "_next")]
    return paired.select(*kept, *[F.col(f"_next.{c}").alias(f"next_{c}") for c in columns])


def edited_by_next(docs: DataFrame) -> DataFrame:
    """Every document with its signatures, the next document's, and those of
    its edited text: the last half of its code points replaced by as many of
    the next document's first (or all of them)."""
    paired = with_next(key_and_text(docs), ["text", "sigs"], lambda df: with_signatures(df, "text", "sigs"))
    edited = paired.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.expr("concat(substring(text, 1, cast(n_chars - n_chars DIV 2 AS int)), substring(next_text, 1, cast(n_chars DIV 2 AS int)))")
    )
    return with_signatures(edited.drop("text", "next_text"), "edited", "edited_sigs")


def similar(prints: DataFrame, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """From ``prints (doc_id, sigs)``: membership ``(doc_id, class_id)`` and
    links ``(a, b, likeness)`` between classes with ``a < b``.

    A class holds the rows with equal sets and is named by its smallest
    ``doc_id``; rows with a null id belong to classes but name none (a class
    of null ids alone is left out).  Empty sets are one class without links.
    """
    named = prints.select("doc_id", "sigs", F.xxhash64("sigs").alias("set"))
    classes = named.groupBy("set").agg(F.min("doc_id").alias("class_id"), F.first("sigs").alias("sigs")).where("class_id IS NOT NULL")
    members = named.join(classes.select("set", "class_id"), "set").select("doc_id", "class_id")

    length, step = F.size("sigs"), math.log(1 / similarity)
    sets = classes.where(length > 0).select("class_id", "sigs", length.alias("n"), F.floor(F.log(length) / step + 1e-9).alias("part"))
    held = sets.select("class_id", "n", "part", F.explode("sigs").alias("sig"))
    # Stored before the join: one straight on the aggregation's partitions could not be split.
    count = stored(held.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "df")
    ranked = held.join(count, "sig").groupBy("class_id", "n", "part").agg(F.sort_array(F.collect_list(F.struct("df", "sig"))).alias("by_df"))
    # Of two sets with this similarity, the n - ceil(similarity n) + 1 rarest of either hold a common one.
    rare = ranked.select("class_id", "n", "part", F.explode(F.expr(f"slice(by_df, 1, cast(n - ceil({similarity}D * n - 1e-9D) + 1 AS int))")).alias("s"))
    rare = rare.select("class_id", "n", "part", F.col("s.sig").alias("sig"))
    short = rare.select(F.col("class_id").alias("x"), F.col("n").alias("nx"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    long = rare.select(F.col("class_id").alias("y"), F.col("n").alias("ny"), "sig", "part")
    fits = f"(nx < ny OR nx = ny AND x < y) AND nx >= {similarity}D * ny - 1e-9D"
    pairs = short.join(long, ["sig", "part"]).where(fits).select("x", "y").distinct()
    a = sets.select(F.col("class_id").alias("x"), F.col("sigs").alias("sx"))
    b = sets.select(F.col("class_id").alias("y"), F.col("sigs").alias("sy"))
    compared = pairs.join(a, "x").join(b, "y").withColumn("likeness", likeness("sx", "sy"))
    links = compared.where(F.col("likeness") >= similarity).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "likeness")
    return members, links
