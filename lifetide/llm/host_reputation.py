"""URL filters: a fixed rule list and an empirical-Bayes host reputation.

``parts`` splits a url into host and path, ``matching_rule`` names the longest
rule that fits.  Where none does, the host's reputation decides: labelled page
outcomes (good or not) are counted per host, registered domain and suffix.  A
suffix is a host's last label, or its last two where those are one of
``SUFFIXES`` (a parameter); the domain is one label more; a numeric address is
its own domain, and all of them share one suffix.  Each level's share is beta-binomial with
the level above as prior mean; how strongly it holds is estimated from the
spread of the level's shares by the method of moments.  So a suffix shrinks
to the overall share, a domain to its suffix and a host to its domain.  A host
is blocked if the upper posterior bound of its share of good pages (the beta
posterior's mean and ``BOUND`` standard deviations, a normal approximation of
its quantile) is under ``min_good``.

Outcomes are counted per host in one pass, partially aggregated, so a hot host
is one row per task before the shuffle; the counts are stored, and the levels,
strengths and posteriors come from them, so outcomes and pages are read once
each.  Pages are joined to stored sides, so adaptive execution can split a host
or domain that has a third of all pages.  No level is collected, only two sums
per level reach the driver.  DataFrame functions alone.

A null url or one without ``://`` has an empty host and path; hosts without
outcomes take their domain's or suffix's share, or the overall one (1/2
without any outcome); outcomes with a null host or result are ignored; a null
``page_id`` and repeated rows are judged like others; an empty table gives an
empty one; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifetide.llm.common import stored

MIN_GOOD = 0.5
#: Standard deviations between the posterior mean and its bound.
BOUND = 1.645
#: Prior strengths stay between these.
WEAKEST, STRONGEST = 1.0, 1000.0
#: Common suffixes of two labels.
SUFFIXES = """
ac.jp ac.uk co.id co.il co.in co.jp co.kr co.nz co.th co.uk co.za com.ar com.au com.br com.cn com.co com.hk com.mx com.my com.ph com.sg
com.tr com.tw com.ua com.vn edu.au gov.au gov.uk ne.jp net.au net.br or.jp or.kr org.au org.br org.nz org.uk
""".split()
#: Suffix of all numeric addresses.
ADDRESS = "(address)"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def parts(url: str) -> tuple[Column, Column]:
    """Host and path of the column ``url``."""
    rest = F.expr(f"CASE WHEN instr(`{url}`, '://') > 0 THEN substring(`{url}`, instr(`{url}`, '://') + 3) ELSE '' END")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host.alias("host"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1).alias("path")


def matching_rule(rules: tuple[Rule, ...], value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits ``host`` and
    ``path`` (of equal ones the first); null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def levels(host: str, suffixes: list[str] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of the column ``host``, without user and port."""
    bare = f"regexp_replace(regexp_replace(`{host}`, '^.*@', ''), ':[0-9]*$', '')"
    numeric = f"({bare} RLIKE '^[0-9]+([.][0-9]+){{3}}$' OR startswith({bare}, '['))"
    two = f"substring_index({bare}, '.', -2)"
    listed = f"{two} IN ({', '.join(map(repr, suffixes)) or 'NULL'})"
    return (
        F.expr(f"CASE WHEN {numeric} THEN {bare} WHEN {listed} THEN substring_index({bare}, '.', -3) ELSE {two} END").alias("domain"),
        F.expr(f"CASE WHEN {numeric} THEN '{ADDRESS}' WHEN {listed} THEN {two} ELSE substring_index({bare}, '.', -1) END").alias("suffix"),
    )


def strength(level: DataFrame, share: float) -> float:
    """Prior strength of a level ``(n, k)``: 1/rho - 1 with the moment
    estimate of the overdispersion rho."""
    row = level.agg(
        F.count(F.lit(1)).alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.expr("cast(n AS double) * n")).alias("squares"),
        F.sum(F.expr(f"n * pow(k / n - {share!r}D, 2)")).alias("spread"),
    ).first()
    groups, n = row["groups"], row["n"] or 0
    room = share * (1 - share)
    if groups < 2 or not room or n <= groups:
        return STRONGEST
    rho = (row["spread"] - room * (groups - 1)) / (room * (n - row["squares"] / n - (groups - 1)))
    return min(STRONGEST, max(WEAKEST, 1 / rho - 1)) if rho > 0 else STRONGEST


@dataclass(frozen=True)
class Reputation:
    """Stored counts per level (``n`` outcomes, ``k`` good ones), the overall
    share and the prior strengths of suffixes, domains and hosts."""

    hosts: DataFrame
    domains: DataFrame
    suffixes: DataFrame
    share: float
    strengths: tuple[float, float, float]


def learn(outcomes: DataFrame, suffixes: list[str] = SUFFIXES) -> Reputation:
    """From ``outcomes (host, good)`` with good 0 or 1."""
    valid = outcomes.select("host", F.col("good").cast("int").alias("good")).where("host IS NOT NULL AND good IN (0, 1)")
    counted = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    hosts = valid.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("k"))
    hosts = stored(hosts.select("*", *levels("host", suffixes)), "hosts")
    domains = stored(hosts.groupBy("domain").agg(*counted), "domains")
    endings = stored(hosts.groupBy("suffix").agg(*counted), "suffixes")
    total = endings.agg(*counted).first()
    share = total["k"] / total["n"] if total["n"] else 0.5
    return Reputation(hosts, domains, endings, share, tuple(strength(x, share) for x in (endings, domains, hosts)))


def rated(pages: DataFrame, known: Reputation, suffixes: list[str] = SUFFIXES) -> DataFrame:
    """``pages`` (with ``host``) and ``reputation, upper``: posterior mean and
    upper bound of the share of good pages of their host."""
    s1, s2, s3 = known.strengths
    joined = (
        pages.select("*", *levels("host", suffixes))
        .join(known.hosts.select("host", F.col("n").alias("n3"), F.col("k").alias("k3")), "host", "left")
        .join(known.domains.select("domain", F.col("n").alias("n2"), F.col("k").alias("k2")), "domain", "left")
        .join(known.suffixes.select("suffix", F.col("n").alias("n1"), F.col("k").alias("k1")), "suffix", "left")
        .na.fill(0, ["n1", "k1", "n2", "k2", "n3", "k3"])
    )
    return (
        joined.withColumn("m1", F.expr(f"(k1 + {s1 * known.share!r}D) / (n1 + {s1!r}D)"))
        .withColumn("m2", F.expr(f"(k2 + {s2!r}D * m1) / (n2 + {s2!r}D)"))
        .withColumn("a", F.expr(f"k3 + {s3!r}D * m2"))
        .withColumn("b", F.expr(f"n3 - k3 + {s3!r}D * (1 - m2)"))
        .select(*pages.columns, F.expr("a / (a + b)").alias("reputation"), F.expr(f"a / (a + b) + {BOUND} * sqrt(a * b / (pow(a + b, 2) * (a + b + 1)))").alias("upper"))
    )


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, min_good: float = MIN_GOOD, suffixes: list[str] = SUFFIXES
) -> DataFrame:
    """``page_id, host, path, rule, verdict, reputation`` of every row of ``pages (page_id, url)``."""
    split = pages.select("page_id", *parts("url"))
    return rated(split, learn(outcomes, suffixes), suffixes).select(
        "page_id", "host", "path",
        matching_rule(rules, "text").alias("rule"),
        F.coalesce(matching_rule(rules, "verdict"), F.when(F.col("upper") < min_good, "block").otherwise("allow")).alias("verdict"),
        "reputation",
    )
