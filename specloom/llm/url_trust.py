"""URL filter: rules first, then trust and distrust spread over the link graph of hosts.

Personalised PageRank spreads trust along links from the hosts of the allow
rules, and distrust against them (who links to bad hosts is suspect) from the
hosts of the block rules. A host is blocked if its distrust outweighs its
trust by ``tolerance``, and allowed otherwise, so hosts that neither reaches
are allowed.

Links are absolute and protocol-relative references in the page. Besides, a
host and the next longer domain that has pages are tied to each other, in both
directions, with the weight of one link: whoever runs a domain answers for its
subdomains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from specloom.session import materialise

# (verdict, host/path): the longest that fits decides.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
# Ranks are spread until none changes by more than this share of itself in a round, and no further host is reached.
SETTLED = 1e-3
# Rounds between two writes of the ranks, after each of which this is looked at.
WRITE_EVERY = 5
# A host name is no longer than this; longer ones are spelled wrong and have no domains above them.
LONGEST_HOST = 253
TOLERANCE = 1.0
# Relative difference below which two ranks count as equal: sums of doubles depend on the order a little.
EQUAL = 1e-9
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rule(pages: DataFrame, rules=RULES) -> DataFrame:
    """``rule`` and its verdict for (host, path); null where none fits."""
    fitting = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits &= F.col("path").startswith(slash + path)
        fitting.append(F.when(fits, F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    best = F.array_max(F.filter(F.array(*fitting), lambda x: x.isNotNull()))
    return pages.withColumn("_best", best).withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.verdict")}).drop("_best")


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, n): links between different hosts, counted, of (host, html)."""
    found = F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']?(?:https?:)?//([^"'\s>/?#]+)"""), F.lit(1))
    links = pages.filter("host <> ''").select(F.col("host").alias("source"), F.explode(found).alias("target"))
    links = links.withColumn("target", F.translate("target", UPPER, LOWER)).filter("source <> target")
    links = links.groupBy("source", "target").agg(F.count("*").alias("n"))
    hosts = pages.filter("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    above = F.transform(
        F.sequence(F.lit(2), F.size(labels)), lambda i: F.struct(i.alias("at"), F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("domain"))
    )
    domains = hosts.filter((F.size(labels) > 1) & (F.length("host") <= LONGEST_HOST)).select("host", F.explode(above).alias("above")).select("host", "above.*")
    nearest = domains.join(hosts.select(F.col("host").alias("domain")), "domain").groupBy("host").agg(F.min_by("domain", "at").alias("domain"))
    ties = nearest.select(F.col("host").alias("source"), F.col("domain").alias("target"))
    ties = ties.unionByName(ties.select(F.col("target").alias("source"), F.col("source").alias("target")))
    both = links.unionByName(ties.withColumn("n", F.lit(1).cast("long")))
    return both.groupBy("source", "target").agg(F.sum("n").alias("n"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """(kind, host, rank): personalised PageRank of both kinds at once, until it has settled.

    ``edges`` (kind, source, target, share): the share of a source's rank that
    a target gets; shares of a source add up to one. ``seeds`` (kind, host,
    start) add up to one for each kind. Rank that ends at a host without
    edges is not handed back. Contributions to a host are added up before
    they are shuffled. As many rounds as the farthest host that a seed reaches has links to it,
    and some forty for what goes round in circles.
    """
    ranks = seeds.select("kind", "host", F.col("start").alias("rank"))
    start = seeds.select("kind", "host", ((1 - damping) * F.col("start")).alias("rank"), F.lit(0.0).alias("before"))
    while True:
        for number in range(WRITE_EVERY):
            given = ranks.withColumnRenamed("host", "source").join(edges, ["kind", "source"])
            given = given.select("kind", F.col("target").alias("host"), (damping * F.col("rank") * F.col("share")).alias("rank"), F.lit(0.0).alias("before"))
            parts = given.unionByName(start)
            if number == WRITE_EVERY - 1:
                parts = parts.unionByName(ranks.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("before")))
            ranks = parts.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("before").alias("before"))
            if number < WRITE_EVERY - 1:
                ranks = ranks.drop("before")
        ranks = materialise(ranks, "host-ranks")
        moved = ranks.filter(F.abs(F.col("rank") - F.col("before")) > settled * F.greatest("rank", "before"))
        ranks = ranks.drop("before")
        if moved.isEmpty():
            return ranks


def url_verdicts(pages: DataFrame, rules=RULES, tolerance: float = TOLERANCE) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) for each row of ``pages`` (page_id, url, html, ...).

    Urls that are null or have no :// have an empty host and path, fit no rule
    and are allowed. Null pages have no links. Rows that repeat come out as
    often; their links count as often. Hosts longer than ``LONGEST_HOST`` have
    no domains above them. Other columns are not looked at.
    """
    seen = pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    seen = with_rule(seen.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html"), rules)
    edges = materialise(host_edges(seen), "host-edges")
    forward = edges.select(F.lit("trust").alias("kind"), "source", "target", "n")
    backward = edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("source"), F.col("source").alias("target"), "n")
    both = forward.unionByName(backward)
    total = both.groupBy("kind", "source").agg(F.sum("n").alias("total"))
    both = materialise(both.join(total, ["kind", "source"]).select("kind", "source", "target", (F.col("n") / F.col("total")).alias("share")), "host-shares")

    kind = F.when(F.col("ruled") == "allow", "trust").otherwise("distrust")
    seeds = seen.filter("ruled is not null and host <> ''").select(kind.alias("kind"), "host").distinct()
    sizes = seeds.groupBy("kind").agg(F.count("*").alias("size"))
    seeds = materialise(seeds.join(F.broadcast(sizes), "kind").select("kind", "host", (1 / F.col("size")).alias("start")), "host-seeds")  # two rows

    ranks = spread(both, seeds)
    ranks = ranks.groupBy("host").agg(*[F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)).alias(k) for k in ("trust", "distrust")])
    judged = seen.drop("html").join(ranks, "host", "left").withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ("trust", "distrust")})
    method = F.when(F.col("distrust") > tolerance * (1 + EQUAL) * F.col("trust"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
