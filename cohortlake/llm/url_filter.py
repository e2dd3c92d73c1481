"""URL filters by rules and by trust over the graph of hosts, with DataFrame functions only.

A rule is a host and a path, like example.net/en/; it fits the host and its
subdomains where the url's path starts with the rule's, and the longest rule
wins. Pages that no rule fits are judged by their host, over the graph of hosts:

* Trust is personalised PageRank along links, from hosts with allowed pages: a host
  hands on its trust in proportion to its links.
* Distrust is personalised PageRank of the reversed graph, from hosts with blocked
  pages: a host hands its distrust back to those that link to it, in proportion to
  their shares of the links that it gets, so that it hands on no more for being popular.

Both seeds are distributions, in proportion to the share of a host's pages that rules
allow or block. Beside each, PageRank from all hosts alike is computed on the same
graph; the part of a host's rank that comes from the seeds is its relative mass, from
0 to 1, which does not depend on the number of hosts. A host is blocked if its relative
distrust reaches the threshold and exceeds its relative trust. Rounds go on until the
ranks have settled; the rest is measured in each. Rank that reaches a host without links
starts anew from the seeds, which is what dividing the ranks by their sum amounts to.

The edges are the hosts' links, weighted by their number: absolute hrefs lead to
their host, relative ones to the page's own. Edges are counted per pair of hosts
before any iteration, so that the graph's size is in hosts, not in pages; the
ranks stay in the shared folder from round to round.

Rules are a short list (they become one expression); a null url, or one without
://, has an empty host and path, is fitted by no rule, and is allowed. Every row
gives a row. Null htmls have no links. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, materialize

#: (verdict, rule)
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
DAMPING = 0.5
#: Share of all rank that may still move when rounds end, and the most rounds.
REST = 1e-7
MOST_ROUNDS = 60
#: Relative distrust from which on a host is blocked; links alone can reach it, as DAMPING lets them give up to a half.
THRESHOLD = 0.2
_HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or end, A-Z lowered."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """After the host up to ?, # or end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fits(rule: str) -> Column:
    host, slash, path = rule.partition("/")
    named = (F.col("host") == host) | F.col("host").endswith("." + host)
    return named & F.col("path").startswith(slash + path)


def by_rules(rules=RULES) -> tuple[Column, Column]:
    """The rule that wins and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, name in sorted(rules, key=lambda x: len(x[1])):  # the longest is asked first
        rule = F.when(fits(name), F.lit(name)).otherwise(rule)
        verdict = F.when(fits(name), F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, along, against: links between hosts with their shares of the links that src has and of those that dst gets."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_HREF))).alias("href")).where("src <> ''")
    absolute = ascii_lower(F.regexp_extract("href", r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//([^/?#]+)", 1))
    other = F.col("href").rlike(r"(?i)^(?:mailto|javascript|tel|data):")
    counted = links.where(~other).select("src", F.when(absolute != "", absolute).otherwise(F.col("src")).alias("dst")).groupBy("src", "dst").count()
    counted = materialize(counted, "host-links")
    for name, end in (("along", "src"), ("against", "dst")):
        totals = counted.groupBy(F.col(end).alias("of")).agg(F.sum("count").alias("total"))
        counted = counted.join(totals, F.col(end) == F.col("of")).drop("of").withColumn(name, F.col("count") / F.col("total")).drop("total")
    return counted.select("src", "dst", "along", "against")


#: Ranks of a host: from all hosts along links, from trusted ones; from all hosts against links, from distrusted ones.
_RANKS = {"all_along": "along", "trust": "along", "all_against": "against", "distrust": "against"}


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rest: float = REST, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """host, trust, distrust (distributions), relative_trust, relative_distrust, from seeds with host, trust, distrust in any measure from 0 to 1."""
    edges = materialize(edges, "host-edges")
    hosts = seeds.select("host", "trust", "distrust").unionByName(edges.select(F.explode(F.array("src", "dst")).alias("host"), F.lit(0.0).alias("trust"), F.lit(0.0).alias("distrust")))
    start = hosts.groupBy("host").agg(F.lit(1.0).alias("all_along"), F.max("trust").alias("trust"), F.lit(1.0).alias("all_against"), F.max("distrust").alias("distrust"))
    start = state = materialize(start, "host-seeds")
    for _ in range(most_rounds):
        # Rows of ranks that move, and of those that start anew; one sum for each host.
        moved = lambda way, of, to: edges.join(state, edges[of] == state["host"]).select(
            F.col(to).alias("to"), *[(damping * F.col(way) * F.col(k) if w == way else F.lit(0.0)).alias(k) for k, w in _RANKS.items()], *[F.lit(0.0).alias(f"was_{k}") for k in _RANKS]
        )
        kept = start.select(F.col("host").alias("to"), *[((1 - damping) * F.col(k)).alias(k) for k in _RANKS], *[F.lit(0.0).alias(f"was_{k}") for k in _RANKS])
        was = state.select(F.col("host").alias("to"), *[F.lit(0.0).alias(k) for k in _RANKS], *[F.col(k).alias(f"was_{k}") for k in _RANKS])
        rows = moved("along", "src", "dst").union(moved("against", "dst", "src")).union(kept).union(was)
        step = materialize(rows.groupBy(F.col("to").alias("host")).agg(*[F.sum(c).alias(c) for k in _RANKS for c in (k, f"was_{k}")]), "host-ranks")
        state = step.select("host", *_RANKS)
        apart = step.agg(*[F.try_divide(F.sum(F.abs(F.col(k) - F.col(f"was_{k}"))), F.sum(k)).alias(k) for k in _RANKS]).first()  # one row
        if max((x or 0.0) for x in apart) <= rest:
            break
    sums = state.agg(*[F.sum(k).alias(f"sum_{k}") for k in ("trust", "distrust")])  # one row
    share = lambda k: F.coalesce(F.col(k) / F.nullif(F.col(f"sum_{k}"), F.lit(0.0)), F.lit(0.0)).alias(k)
    return state.crossJoin(F.broadcast(sums)).select("host", share("trust"), share("distrust"), (F.col("trust") / F.col("all_along")).alias("relative_trust"), (F.col("distrust") / F.col("all_against")).alias("relative_distrust"))


def host_scores(pages: DataFrame, rules=RULES) -> DataFrame:
    """What propagate gives for each host; seeds are the shares of a host's pages that rules allow and block."""
    _, verdict = by_rules(rules)
    seeds = (
        pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).where("host <> ''").select("host", verdict.alias("verdict"))
        .groupBy("host").agg(F.count_if(F.col("verdict") == "allow").alias("allowed"), F.count_if(F.col("verdict") == "block").alias("blocked"), F.count("*").alias("n"))
        .select("host", (F.col("allowed") / F.col("n")).alias("trust"), (F.col("blocked") / F.col("n")).alias("distrust"))
    )
    return propagate(seeds, host_edges(pages))


def judge_urls(pages: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    pages = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    blocked = host_scores(pages, rules).where(f"relative_distrust >= {threshold} AND relative_distrust > relative_trust").select(F.col("host").alias("blocked_host"))
    rule, verdict = by_rules(rules)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).withColumns({"rule": rule, "by_rule": verdict})
    rows = rows.join(blocked, F.col("host") == F.col("blocked_host"), "left")
    method = F.when(F.col("blocked_host").isNotNull(), "block").otherwise("allow")
    return rows.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"))
