"""URL filters: rules by host and path, and link-graph propagation for the hosts no rule settles.

Method: personalised PageRank spreads trust from trusted seeds along host edges, and distrust from
blocked seeds against them. Edges are the links in the pages' html, those without a host (relative ones)
to the page's own host, and one for each page from its host to the domain above it (of two labels at
least), which answers for it. A host's seed weights are the shares of its pages that the rules allow
and block. A host without edges on the way out keeps its mass. Each host is judged by thresholds on
shares, which don't depend on how many hosts or links there are: of the mass that reaches it from other
hosts, the part that comes from seeds, compared with a walk that starts from every host alike; or its
own seed weight where that is more. DataFrame functions only.

The walk's fixed point is found by Jacobi steps: what an edge of a host to itself returns, and what a
host without edges keeps, is summed at once, so only mass that passes to other hosts takes rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release, staged

#: (verdict, rule). A rule is a host and a path: it fits the host and its subdomains.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ABOVE = r"^[^.]+\.([^.]+\..+)$"
HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*([^"'\s<>]+)"""
#: What has a scheme, but no host; and places in the page itself.
NO_HOST, OTHER_HOST = r"(?i)^(?:[a-z][a-z0-9+.-]*:|#)", r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//"
DAMPING, BLOCK_FROM, TOLERANCE = 0.85, 0.5, 1e-4


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def by_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, n): links in the pages' html by host, and each page's edge to the domain above its host, counted."""
    known = pages.filter(F.col(host) != "")
    links = known.select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("url"))
    links = links.withColumn("far", F.col("url").rlike(OTHER_HOST)).filter(F.col("far") | ~F.col("url").rlike(NO_HOST))
    url = F.when(F.startswith("url", F.lit("//")), F.concat(F.lit("http:"), "url")).otherwise(F.col("url"))
    links = links.select("src", F.when(F.col("far"), host_of(url)).otherwise(F.col("src")).alias("dst"))
    above = known.select(F.col(host).alias("src"), F.regexp_extract(F.col(host), ABOVE, 1).alias("dst"))
    return links.unionByName(above).filter("dst <> ''").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, trust_share, distrust_share) from seeds (host, trust, distrust) over edges (src, dst, n).

    Rounds go on until no mass changes by more than `tolerance` of the mass of the unseeded walk."""
    linked = links.select(F.col("src").alias("host")).union(links.select(F.col("dst").alias("host"))).distinct()
    nodes = linked.join(seeds, "host", "full").select("host", F.coalesce("trust", F.lit(0.0)).alias("t0"), F.coalesce("distrust", F.lit(0.0)).alias("d0"))
    own = F.sum(F.when(F.col("src") == F.col("dst"), F.col("n")))
    out = links.groupBy(F.col("src").alias("host")).agg(F.sum("n").alias("all_out"), own.alias("own_out"))
    into = links.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("all_in"), own.alias("own_in"))
    nodes = nodes.join(out, "host", "left").join(into, "host", "left")
    stays = lambda way: F.when(F.col(f"all_{way}").isNull(), 1.0).otherwise(F.coalesce(f"own_{way}", F.lit(0)) / F.col(f"all_{way}"))
    # the part of what a host gives that it does not get back itself
    nodes = nodes.select("host", "t0", "d0", F.lit(1.0).alias("v0"), F.lit(1.0).alias("u0"), "all_out", "all_in", (1 - damping * stays("out")).alias("net_out"), (1 - damping * stays("in")).alias("net_in"))
    nodes, edges = staged(nodes, "hosts"), staged(links.filter("src <> dst"), "host-edges")
    # trust and its unseeded walk v go along edges, distrust and u against them
    along, against = ("t", "v"), ("d", "u")
    every = along + against
    zero = lambda names: [F.lit(0.0).alias(x) for x in names]
    mass = lambda x: ((F.lit(1 - damping) * F.col(f"{x}0") + F.lit(damping) * F.col(f"got_{x}")) / F.col("net_out" if x in along else "net_in")).alias(x)
    now = nodes.withColumns({f"got_{x}": F.lit(0.0) for x in every})
    now = staged(now.select("*", *map(mass, every)), "ranks")
    while True:
        given = now.select("host", "all_out", "all_in", *every)
        onward = edges.join(given, edges.src == given.host).select(F.col("dst").alias("host"), *[(F.col(x) * F.col("n") / F.col("all_out")).alias(x) for x in along], *zero(against))
        back = edges.join(given, edges.dst == given.host).select(F.col("src").alias("host"), *zero(along), *[(F.col(x) * F.col("n") / F.col("all_in")).alias(x) for x in against])
        got = onward.unionByName(back).groupBy("host").agg(*[F.sum(x).alias(f"got_{x}") for x in every])
        last = now.select("host", *[F.col(x).alias(f"last_{x}") for x in every])
        new = nodes.join(got, "host", "left").join(last, "host").fillna(0.0, [f"got_{x}" for x in every])
        new = staged(new.select("*", *map(mass, every)), "ranks")
        release(now)
        now = new
        moved = [F.abs(F.col(x) - F.col(f"last_{x}")) > F.lit(tolerance) * F.col(walk) for x, walk in (("t", "v"), ("v", "v"), ("d", "u"), ("u", "u"))]
        if now.filter(moved[0] | moved[1] | moved[2] | moved[3]).isEmpty():
            break
    share = lambda x, walk: F.greatest(F.col(f"{x}0"), F.when(F.col(f"got_{walk}") > 0, F.col(f"got_{x}") / F.col(f"got_{walk}")).otherwise(0.0))
    return now.select("host", F.col("t").alias("trust"), F.col("d").alias("distrust"), share("t", "v").alias("trust_share"), share("d", "u").alias("distrust_share"))


def judge_urls(
    pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html: str = "html", rules: list[tuple[str, str]] = RULES, damping: float = DAMPING, tolerance: float = TOLERANCE, block_from: float = BLOCK_FROM
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust with their shares, for every row.

    A page without a rule is blocked if its host's share of distrust is above its share of trust and at
    least `block_from` (a tie of both is no block). Null urls and urls without `://` have empty host and
    path, fit no rule, are allowed and link nowhere. Null html has no links; html of any length is read whole.
    Rows are judged one by one, repeated and null ids too; a repeated row's links count each time. No rows give
    none; further columns are ignored, whatever their names.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), F.col(html).alias("html"))
    rule, ruled = by_rules(F.col("host"), F.col("path"), rules)
    links = staged(host_links(rows, "host", "html"), "links")
    judged = rows.select("page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"))
    share = lambda what: F.sum(F.when(F.col("ruled") == what, 1).otherwise(0)) / F.count("*")
    seeds = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    hosts = staged(propagate(seeds, links, damping, tolerance), "host-verdicts")  # of known size: broadcast only if small, else joined with skewed hosts split
    joined = judged.join(hosts, "host", "left")
    spread = F.when((F.col("distrust_share") > F.col("trust_share")) & (F.col("distrust_share") >= block_from), F.lit("block")).otherwise(F.lit("allow"))
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", spread).alias("verdict"), "trust", "distrust", "trust_share", "distrust_share")
