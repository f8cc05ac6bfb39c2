"""Verdicts on urls: rules first, then trust and distrust that spread along links of hosts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import lower_ascii, settled, stored

ALLOW, BLOCK = "allow", "block"
#: Verdict and rule: a host with its subdomains, and the beginning of the path.
RULES = ((BLOCK, "net/"), (ALLOW, "example.net/en/"), (BLOCK, "example.com/de/"), (ALLOW, "org/fr/"))

#: Share of a score that goes along links; scores are passed on until none changes by more than
#: the tolerance over some rounds, which the damping sees to before the last.
DAMPING, TOLERANCE, TOGETHER, LAST = 0.85, 1e-6, 4, 100
#: A host is blocked when its distrust exceeds its trust and reaches what it would have if
#: this share of its own pages were blocked by rule and none of its links led to a blocked host.
BLOCKED_SHARE = 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: The link of a tag, from its name to its end: ``href`` as an attribute's whole name.
_TAG = r"""(?is)^a[\s/][^>]*"""
_HREF = r"""(?is)[\s"'/]href\s*=\s*["']?([^"'\s>]+)"""
_ABSOLUTE = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased, or ``''``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, NULL where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, begin = rule.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{begin}")
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def ruled(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``; the last two are NULL where no rule fits."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules))
    return rows.select("page_id", "host", "path", "r.rule", "r.verdict")


def links_of(html: Column) -> Column:
    """What the ``a`` tags of a page link to, in order; each tag's first ``href`` counts.

    The text is cut at every ``<`` and each tag is looked at by itself, so that the work grows with
    the length of the text, whatever is left open in it.
    """
    tags = F.filter(F.split(html, "<", -1), lambda t: F.lower(F.substring(t, 1, 1)) == "a")
    inside = F.transform(tags, lambda t: F.regexp_extract(t, _TAG, 0))
    return F.filter(F.transform(inside, lambda t: F.regexp_extract(t, _HREF, 1)), lambda link: link != "")


def host_edges(pages: DataFrame) -> DataFrame:
    """``(source, target, links)``: absolute links from pages of one host to another host.

    A link is absolute if it begins with a scheme and ``://``, or with ``//``; one that merely holds an
    url, as in ``/out?u=http://x``, stays on its host. Each row of a repeated page counts. The text of
    a page of any length stays in the task that reads it; pages without ``html`` link nowhere.
    """
    away = F.filter(links_of(F.col("html")), lambda x: x.rlike(_ABSOLUTE))
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    links = pages.select(host_of(F.col("url")).alias("source"), F.explode(away).alias("link"))
    links = links.select("source", target.alias("target")).where("source <> '' AND target <> '' AND source <> target")
    return links.groupBy("source", "target").agg(F.count("*").alias("links"))


def spread(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, last: int = LAST
) -> DataFrame:
    """``(host, trust, distrust)`` by personalised PageRank from ``(host, trusted, blocked)``.

    Trust is the PageRank of a walk from trusted seeds: it goes from a host to those it links to,
    shared out by the number of links. Distrust is the reverse: the PageRank that a walk from
    the host itself gives to blocked seeds. It comes back along links, each host taking the mean over
    its own links, so it does not shrink when many hosts link to the same blocked one. Both run in
    one table, as one join and one sum a round, until no score changes by more than ``tolerance``;
    what has nowhere to go is lost. Sums begin within each task, so a host with many links in is no hot spot.
    """
    out = edges.groupBy(F.col("source").alias("host")).agg(F.sum("links").alias("all"))
    parts = edges.join(out, edges["source"] == out["host"]).select("source", "target", (F.col("links") / F.col("all")).alias("part"))
    forth = parts.select(F.lit("t").alias("kind"), F.col("source").alias("giver"), F.col("target").alias("taker"), "part")
    back = parts.select(F.lit("d").alias("kind"), F.col("target").alias("giver"), F.col("source").alias("taker"), "part")
    ways = stored(forth.union(back))
    both = F.explode(
        F.array(F.struct(F.lit("t").alias("kind"), F.col("trusted").alias("s")), F.struct(F.lit("d").alias("kind"), F.col("blocked").alias("s")))
    )
    base = settled(seeds.select("host", both.alias("x")).select("host", "x.kind", (F.col("x.s") * (1 - damping)).alias("score")).where("score > 0"))
    now, rounds = base, 0 if ways.isEmpty() else last
    for _ in range(0, rounds, TOGETHER):
        before = now
        for _ in range(TOGETHER):
            given = ways.join(now.withColumnRenamed("host", "giver"), ["kind", "giver"])
            given = given.select(F.col("taker").alias("host"), "kind", (F.col("score") * F.col("part") * damping).alias("score"))
            now = base.union(given).groupBy("host", "kind").agg(F.sum("score").alias("score"))
        now = settled(now)
        moved = now.join(before.withColumnRenamed("score", "was"), ["host", "kind"], "left")
        most = moved.agg(F.max(F.abs(F.col("score") - F.coalesce("was", F.lit(0.0))))).first()[0]
        if most is None or most <= tolerance:
            break
    each = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return now.groupBy("host").agg(each("t").alias("trust"), each("d").alias("distrust"))


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    damping: float = DAMPING,
    tolerance: float = TOLERANCE,
    blocked_share: float = BLOCKED_SHARE,
) -> DataFrame:
    """``(page_id, host, path, rule, verdict)``, one row per row of ``(page_id, url, html)``.

    Where a rule fits, it decides. Seeds are the shares of a host's pages that rules allow and
    block, so a rule for one section of a site says little about the rest of it. Other pages
    have their host's verdict, and those without a host are allowed. Where trust and distrust are
    equal, the host is allowed. An empty table gives no rows.
    """
    rows = ruled(pages, rules)
    share = lambda v: F.count(F.when(F.col("verdict") == v, 1)) / F.count("*")
    seeds = rows.where("host <> ''").groupBy("host").agg(share(ALLOW).alias("trusted"), share(BLOCK).alias("blocked"))
    scores = spread(host_edges(pages), seeds, damping, tolerance)
    bad = scores.where((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= blocked_share * (1 - damping)))
    bad = bad.select("host", F.lit(BLOCK).alias("by_host"))
    out = rows.join(bad, "host", "left")
    verdict = F.coalesce("verdict", "by_host", F.lit(ALLOW))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
