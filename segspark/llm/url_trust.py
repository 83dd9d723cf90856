"""URL filter: rules first, then trust and distrust spread over the links between hosts.

A rule is `host/path`; it fits its host and all subdomains where the url's path begins with the rule's
path. The longest fitting rule decides (of equal length, the first in the alphabet). Other urls get the
verdict of their host, which comes from the link graph alone:

* trust is personalised PageRank along the links, from the hosts of allowed urls;
* distrust is personalised PageRank against the links (who links to bad hosts is suspect), from the
  hosts of blocked urls;
* a seed's own share does not count, since its rules have already spoken for its urls: only what
  flows in from other hosts does;
* a host is blocked when distrust exceeds trust and is at least `least` times the average host's rank.

Links are counted once per page and added up per pair of hosts before any shuffle of links, so a
host with a third of all pages is a few rows. Each round is one join and one aggregate over host
pairs, written as a table; ranks are the sum of the rounds. No row-level data reaches the driver, and
there is no Python on executors.

Results for odd cases: a url that is null or has no `://` has an empty host and path and belongs to
no rule; the empty host has no links and is allowed. Null html has no links. Very long html is scanned
whole. Repeated pages give repeated rows and count as pages. An empty table gives an empty result.
Page columns are read into names of our own, so other columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segspark.session import materialize

DAMPING, ROUNDS, LEAST = 0.85, 20, 1.0
LINK = "(?i)<a[\\x20\\x09-\\x0D][^>]*?href[\\x20\\x09-\\x0D]*=[\\x20\\x09-\\x0D]*[\"']?([^\"'\\x20\\x09-\\x0D>]+)"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The deciding rule, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(sorted(rules, reverse=True), key=len):
        on, _, rest = rule.partition("/")
        fits = ((host == on) | host.endswith("." + on)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def host_links(html: Column) -> Column:
    """The distinct hosts that a page links to by absolute links."""
    targets = F.regexp_extract_all(F.coalesce(html.cast("string"), F.lit("")), F.lit(LINK), F.lit(1))
    absolute = F.filter(targets, lambda t: t.contains("://") | t.startswith("//"))
    hosts = F.transform(absolute, lambda t: host_of(F.when(t.startswith("//"), F.concat(F.lit("x:"), t)).otherwise(t)))
    return F.array_distinct(F.filter(hosts, lambda h: h != ""))


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(src, dst, out, back): per pair of hosts, its share of what src links to and of what links to dst."""
    links = pages.select(host_of(F.col(url)).alias("src"), F.explode(host_links(F.col(html))).alias("dst"))
    pairs = materialize(links.filter("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n")))
    sent = pairs.groupBy("src").agg(F.sum("n").alias("sent"))
    got = pairs.groupBy("dst").agg(F.sum("n").alias("got"))
    return pairs.join(sent, "src").join(got, "dst").select(
        "src", "dst", (F.col("n") / F.col("sent")).alias("out"), (F.col("n") / F.col("got")).alias("back")
    )


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """What flows into each host: (host, trust, distrust), without the seeds' own share."""
    flow = seeds
    total = None
    for _ in range(rounds):
        forward = edges.join(flow.filter("trust > 0"), edges["src"] == flow["host"]).select(
            F.col("dst").alias("to"), (F.col("trust") * F.col("out") * damping).alias("t"), F.lit(0.0).alias("d")
        )
        backward = edges.join(flow.filter("distrust > 0"), edges["dst"] == flow["host"]).select(
            F.col("src").alias("to"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("back") * damping).alias("d")
        )
        flow = materialize(
            forward.unionAll(backward).groupBy("to").agg(F.sum("t").alias("trust"), F.sum("d").alias("distrust")).withColumnRenamed("to", "host")
        )
        total = flow if total is None else total.unionAll(flow)
        if flow.isEmpty():
            break
    scale = F.lit(1 - damping)
    return total.groupBy("host").agg((F.sum("trust") * scale).alias("trust"), (F.sum("distrust") * scale).alias("distrust"))


def judge_pages(
    pages: DataFrame, rules: dict[str, str], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    damping: float = DAMPING, rounds: int = ROUNDS, least: float = LEAST,
) -> DataFrame:
    """Per page: id, host, path, rule, verdict. `rules` maps `host/path` to allow or block."""
    own = pages.select(F.col(id_col).alias("~id"), F.col(url_col).alias("~url"), F.col(html_col).alias("~html"))
    judged = own.select("~id", host_of(F.col("~url")).alias("host"), path_of(F.col("~url")).alias("path"))
    judged = judged.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    judged = judged.withColumn("ruled", by_rule)

    edges = materialize(host_edges(own, "~url", "~html"))
    per_host = materialize(
        judged.groupBy("host").agg(F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked"))
    )
    totals = per_host.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    seeds = per_host.filter("host <> '' AND allowed + blocked > 0").select(
        "host", (F.col("allowed") / F.lit(float(totals["a"] or 1) or 1.0)).alias("trust"),
        (F.col("blocked") / F.lit(float(totals["b"] or 1) or 1.0)).alias("distrust"),
    )
    hosts = per_host.select("host").union(edges.select("src")).union(edges.select("dst")).filter("host <> ''").distinct().count()
    ranks = spread(seeds, edges, damping, rounds)
    bad = ranks.filter((F.col("distrust") > F.col("trust")) & (F.col("distrust") * hosts >= least)).select(F.col("host").alias("bad_host"))
    out = judged.join(bad, judged["host"] == bad["bad_host"], "left")
    verdict = F.coalesce("ruled", F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow"))
    return out.select(F.col("~id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"))
