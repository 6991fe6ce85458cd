"""Operator 10: URL filters by rules and link-graph propagation.

DataFrame operations only.  A page is judged by the longest rule that fits
its host and path.  Pages without a rule are judged by their host: trust
flows from hosts with allowed pages along links (personalised PageRank), and
distrust flows from hosts with blocked pages against the direction of links
(a page that links to blocked pages is suspect); a host whose share of
distrust exceeds ``threshold`` is blocked.

Links are absolute ``href`` targets, those without a scheme (``//host/x``)
included, counted once for each pair of hosts
with their number as weight, so the graph is pre-aggregated before anything
is joined.  Each iteration is one join of the ranks with the edges and one
aggregation by target; lineage is cut in the shared folder.  It goes on until
no further host is reached and the ranks change by less than ``tolerance`` of
their sum.  Seeds are the share of a host's pages that the rules allow or
block.

Defined results: a NULL url, or one without ``://``, has an empty host and
path, fits no rule and is allowed; repeated rows are judged alike and weigh
as rows; NULL html has no links; hosts without any evidence are allowed;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .decontaminate import LOWER, UPPER
from .tables import written

#: Fixed values: (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
HREF = r"""(?i)href\s{0,9}=\s{0,9}["']?((?:[a-z]+:)?//[^"'\s<>]+)"""
ROUNDS = 4              # of propagation between two looks at the change


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else NULL."""
    ordered = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    return F.coalesce(*[
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
        for h, p, v in ordered])


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts."""
    link = F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1)))
    return (pages.where(F.col("html").contains("//"))
            .select(host(F.col("url")).alias("src"), link.alias("link"))
            # a link without a scheme has the page's: any will do to find its host
            .select("src", host(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link"))
                                .otherwise(F.col("link"))).alias("dst"))
            .where("src <> dst and src <> '' and dst <> ''")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight")))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """Personalised PageRank: ``seeds`` (node, seed) and ``edges``
    (src, dst, weight) to (node, rank), until it settles."""
    total = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    share = edges.join(total, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("share"))
    share = written(share, "host-edges")
    rank = seeds.select("node", (F.col("seed") * (1 - damping)).alias("rank"))
    if share.isEmpty():
        return rank
    rank = written(rank, "host-ranks")
    while True:
        new = rank
        for _ in range(ROUNDS):
            flow = (share.join(new, share["src"] == new["node"]).groupBy("dst")
                    .agg(F.sum(F.col("rank") * F.col("share") * damping).alias("flow")))
            new = (flow.withColumnRenamed("dst", "node").join(seeds, "node", "full")
                   .select("node", (F.coalesce("flow", F.lit(0.0))
                                    + F.coalesce("seed", F.lit(0.0)) * (1 - damping)).alias("rank")))
        new = written(new, "host-ranks")
        moved = new.join(rank.withColumnRenamed("rank", "was"), "node", "left").agg(
            F.coalesce(F.sum(F.abs(F.col("rank") - F.coalesce("was", F.lit(0.0)))), F.lit(0.0)).alias("change"),
            F.coalesce(F.sum("rank"), F.lit(0.0)).alias("sum"), F.count_if(F.col("was").isNull()).alias("reached")).first()
        if not moved["reached"] and moved["change"] <= tolerance * moved["sum"]:
            return new
        rank = new


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, damping: float = 0.85,
          threshold: float = 0.75, tolerance: float = 1e-6) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, trust and distrust
    of the host."""
    rows = (pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
            .withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)))
    rows = rows.select("page_id", "host", "path", "fit.rule", F.col("fit.verdict").alias("ruled"))
    per_host = rows.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"))
    per_host = written(per_host, "hosts")
    edges = written(host_edges(pages), "host-links")
    scores = {}
    turned = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    for name, column, graph in (("trust", "allowed", edges), ("distrust", "blocked", turned)):
        seeds = per_host.where(F.col(column) > 0).select(
            F.col("host").alias("node"), (F.col(column) / F.col("pages")).alias("seed"))
        scores[name] = propagate(graph, seeds, damping, tolerance).withColumnRenamed("rank", name)
    known = scores["trust"].join(scores["distrust"], "node", "full").select(
        "node", F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    judged = rows.join(known, rows["host"] == known["node"], "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > threshold * (trust + distrust), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"),
                         trust.alias("trust"), distrust.alias("distrust"))
