"""URL filter: fixed host/path rules, and for all other pages trust propagated over host links.

Every url gets its host and path; the longest fitting rule decides.  Where none fits, the page's
host is judged by personalised PageRanks over the host graph.  A host seeds them by its pages: trust
by the share that a rule allows, distrust by the share that a rule blocks, and a neutral rank by the
rest.  Trust and the neutral rank follow links; distrust goes against them (who links to blocked
hosts is suspect).  A host is blocked when distrust exceeds trust and is at least ``threshold`` of all
three ranks that reach it: relative, so that it does not matter how well a host is linked.

Host edges are the absolute links of the pages (one edge per pair of hosts, weighted by links) and
one edge up and one down between a host and each domain above it, down to two labels, whether or not
the domain has pages: hosts of one domain pass trust and distrust on to each other even where
pages link only within their host.  Everything is DataFrame work on tables of hosts: edges are summed before
they are joined, ranks are whole numbers of a fixed unit - so the result does not depend on the
order of additions - and written every few rounds.  After k rounds at most damping^(k + 1) of the
seeds' mass is not counted, whatever the graph; rounds go on until that is below ``TOLERANCE``, or
until a step adds less.  Pages meet their host's verdict in one join on the host, which AQE splits
when a host has very many pages; html is read once, for the links, and never shuffled.

Defined results: a NULL url or one without ``://`` has empty host and path, fits no rule and is
allowed; NULL html has no links, very long html is read whole; repeated rows are judged alike and count as
pages; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abtforge.llm.store import written

# (verdict, host and path of the rule): fixed values
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.85
TOLERANCE = 1e-3
STEP = 7
THRESHOLD = 0.2
_UNIT = 10 ** 12
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (as text) that fits host or a parent domain and starts the path; else NULL."""
    chosen = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        chosen = F.when(fits, F.lit(rule)).otherwise(chosen)
    return chosen


def domain_edges(hosts: DataFrame) -> DataFrame:
    """(src, dst, links): one edge each way between every host or domain and the domain above it.

    Domains of one label, and addresses of digits, have none above.
    """
    labels = F.split("host", r"\.")
    above = F.when(F.col("host").rlike(r"^[\d.:]+$"), F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    chain = hosts.select(above.alias("chain")).where(F.size("chain") > 1)
    pairs = chain.select(F.explode(F.transform(F.slice("chain", F.lit(1), F.size("chain") - 1), lambda child, i: F.struct(child.alias("child"), F.get("chain", i + 1).alias("parent")))).alias("p"))
    both = pairs.select("p.child", "p.parent").where("child <> '' AND parent <> ''").distinct()
    return both.select(F.explode(F.array(F.struct(F.col("child").alias("src"), F.col("parent").alias("dst")),
                                         F.struct(F.col("parent").alias("src"), F.col("child").alias("dst")))).alias("e")).select("e.src", "e.dst", F.lit(1).cast("long").alias("links"))


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, links): distinct host pairs, by links between pages and by the domains above."""
    linked = F.when(F.contains(F.col("html"), F.lit("//")), F.regexp_extract_all(F.col("html"), F.lit(_LINK), F.lit(1)))
    links = (pages.select(url_host(F.col("url")).alias("src"), F.explode(linked).alias("dst"))
             .select("src", lower_ascii(F.col("dst")).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst")
             .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))
    return links.unionByName(domain_edges(hosts)).groupBy("src", "dst").agg(F.sum("links").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(kind, host, mass): personalised PageRank from ``seeds`` (kind, host, mass) over
    ``edges`` (kind, src, dst, links); masses are whole numbers, and of all seeds' mass at most ``tolerance`` is not counted."""
    out_of = edges.groupBy("kind", "src").agg(F.sum("links").alias("all_links"))
    shares = written(edges.join(out_of, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("links") / F.col("all_links")).alias("share")), "links")
    seeds = written(seeds.select("kind", "host", "mass"), "seeds")
    own = seeds.select("kind", "host", F.floor(F.col("mass") * (1 - damping)).alias("mass"))
    total = lambda df: int(df.agg(F.coalesce(F.sum("mass"), F.lit(0))).first()[0])
    rank, all_mass, counted, rounds = own, total(seeds), total(own), 0
    while damping ** (rounds + 1) > tolerance:
        for _ in range(STEP):
            passed = rank.join(shares, ["kind", "host"]).select("kind", F.col("dst").alias("host"), F.floor(F.col("mass") * F.col("share") * damping).alias("mass"))
            rank = own.unionByName(passed).groupBy("kind", "host").agg(F.sum("mass").alias("mass"))
        rank, rounds = written(rank, "ranks"), rounds + STEP
        # every step adds at most damping^STEP of what the step before added
        grown, counted = total(rank) - counted, total(rank)
        if grown * damping ** STEP <= tolerance * all_mass * (1 - damping ** STEP):
            break
    return rank


def judge_pages(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """page_id, host, path, rule, verdict, decided_by, trust, distrust, neutral: one row per row of ``pages``."""
    verdicts = {rule: verdict for verdict, rule in rules}
    pages = pages.select("page_id", "url", "html")
    parsed = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = parsed.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdicts.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    ruled = ruled.withColumn("by_rule", by_rule)
    share = lambda verdict: F.floor(F.avg(F.when(F.col("by_rule") == verdict, 1.0).otherwise(0.0)) * _UNIT)
    hosts = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    hosts = written(hosts.withColumn("neutral", F.lit(_UNIT) - F.col("trust") - F.col("distrust")), "hosts")
    links = host_edges(pages, hosts.select("host"))
    kinds = ("trust", "distrust", "neutral")
    forward = links.select(F.explode(F.array(F.lit("trust"), F.lit("neutral"))).alias("kind"), "src", "dst", "links")
    backward = links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    seeds = hosts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("mass")) for k in kinds])).alias("s"), "host")
    ranks = propagate(seeds.select("s.kind", "host", "s.mass").where("mass > 0"), forward.unionByName(backward), damping, tolerance)
    mass = lambda kind: F.round(F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0)) / (_UNIT * (1 - damping)), 6).alias(kind)
    scored = ranks.groupBy(F.col("host").alias("_host")).agg(*map(mass, kinds))
    out = ruled.join(scored, ruled["host"] == scored["_host"], "left").fillna(0.0, list(kinds))
    everything = F.col("trust") + F.col("distrust") + F.col("neutral")
    method = F.when((F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold * everything), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"),
                      F.when(F.col("rule").isNull(), "method").otherwise("rule").alias("decided_by"), *kinds)
