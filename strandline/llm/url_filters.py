"""Operator 9: URL rules, and trust and distrust spread over the graph of hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm.common import LOWER, UPPER, read, stored

#: Hosts up to which their verdicts are broadcast to the pages; beyond, the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Rounds of the graph between two written tables.
ROUNDS = 8


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, as in ``example.com/en/``; verdict is allow or block."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


#: The rules of the registered query.
RULES = (
    Rule("com/en/", "block"),
    Rule("example.com/en/7", "allow"),
    Rule("net/de/", "allow"),
    Rule("example.net/de/8", "block"),
    Rule("org/es/", "block"),
)


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty where it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, else nulls."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        text, verdict = F.when(fits, F.lit(r.text)).otherwise(text), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, weight): links between hosts, and a host with the host one label above.

    Absolute links are read from href and src; relative ones stay within the host and add
    nothing. Repeated links of one pair of hosts are summed before they move.
    """
    link = r"""(?i)(?:href|src)\s*=\s*["']?(?:https?:)?//([^"'\s>/?#]+)"""
    found = pages.where(F.col(host) != "").select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(link), F.lit(1))).alias("dst"))
    links = found.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).where("src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    links = stored(links, "links")  # pages are read for links once
    hosts = pages.where(F.col(host) != "").select(F.col(host).alias("h")).union(links.select("dst")).distinct()
    # every ancestor of two labels or more, each below the one a label longer
    label = F.split("h", r"\.")
    steps = F.transform(F.sequence(F.lit(1), F.size(label) - 2), lambda i: F.array_join(F.slice(label, i, F.size(label)), "."))
    chain = F.when(F.size(label) > 2, F.concat(steps, F.array(F.array_join(F.slice(label, F.size(label) - 1, 2), "."))))
    links_up = hosts.select(chain.alias("c")).where("c is not null").select(F.explode(F.arrays_zip(F.slice("c", 1, F.size("c") - 1).alias("src"), F.slice("c", 2, F.size("c") - 1).alias("dst"))).alias("e"))
    tree = links_up.select("e.src", "e.dst").distinct()
    both = tree.union(tree.select("dst", "src")).select("src", "dst", F.lit(1.0).alias("weight"))
    return links.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-6, most: int = 40) -> DataFrame:
    """(side, host, rank): personalised PageRank over ``edges`` (side, src, dst, weight) from ``seeds`` (side, host, seed).

    Sides are graphs of their own that take their rounds together. What is under way is moved a
    link further each round and added to the ranks, until it is at most ``tolerance`` of the
    seeds in sum and no new host has been reached. A host keeps its rank by an edge to itself,
    so that a round is one join and one sum; every ``ROUNDS`` rounds the ranks are cut off from
    their lineage in the shared folder. What a host without edges out would pass on is lost,
    which only scales down its own surroundings.
    """
    out = edges.groupBy("side", "src").agg(F.sum("weight").alias("total"))
    share = edges.join(out, ["side", "src"]).select("side", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("total") * damping).alias("share"), F.lit(0.0).alias("stay"))
    hosts = edges.select("side", "src").union(edges.select("side", "dst")).union(seeds.select("side", "host")).distinct().toDF("side", "host")
    share = stored(share.union(hosts.select("side", "host", "host", F.lit(0.0), F.lit(1.0))), "shares")
    ranks = seeds.select("side", "host", (F.col("seed") * (1 - damping)).alias("rank"), (F.col("seed") * (1 - damping)).alias("moving"))
    whole = {r[0]: r[1] for r in ranks.groupBy("side").agg(F.sum("rank")).collect()}
    reached = None
    for _ in range(most):
        for _ in range(ROUNDS):
            moved = ranks.join(share, ["side", "host"]).groupBy("side", "dst").agg(F.sum(F.col("rank") * F.col("stay")).alias("rank"), F.sum(F.col("moving") * F.col("share")).alias("moving"))
            ranks = moved.select("side", F.col("dst").alias("host"), (F.col("rank") + F.col("moving")).alias("rank"), "moving")
        ranks = stored(ranks, "ranks")
        now = {r[0]: r[1:] for r in ranks.groupBy("side").agg(F.count_if(F.col("rank") > 0), F.sum("moving")).collect()}
        if all(left <= tolerance * whole[side] and (reached or {}).get(side, (-1,))[0] == n for side, (n, left) in now.items()):
            return ranks.where("rank > 0").select("side", "host", "rank")
        reached = now
    raise RuntimeError(f"ranks still spread after {most * ROUNDS} rounds")


def significant(x: Column, digits: int = 6) -> Column:
    """``x`` rounded to so many significant digits, however small it is; 0 stays 0."""
    scale = F.pow(F.lit(10.0), digits - 1 - F.floor(F.log10(x)))
    return F.when(x > 0, F.rint(x * scale) / scale).otherwise(F.lit(0.0))


def url_filters(pages: DataFrame, rules: tuple[Rule, ...] = RULES, ratio: float = 1.0, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Judge every URL by the longest rule that fits it, else by its host's place in the graph.

    Hosts with allowed pages are trusted seeds, each as much as its share of them; hosts with
    blocked pages are seeds of distrust, which runs against the edges. Both are spread by
    personalised PageRank until it no longer changes. A host is blocked where its distrust exceeds
    ``ratio`` times its trust; both have six significant digits, at any size of the table.

    Returns key, host, path, rule, verdict, trust, distrust, one row for each input row. A null
    URL, or one without ``://``, has an empty host and path and is allowed, as is a host
    without any rank; null HTML has no links; null keys and repeated rows are judged each; an
    empty table gives an empty result; a very long URL or page is read whole; other columns are
    ignored.
    """
    host, path = parsed(F.col(url))
    rows = pages.select(F.col(key), host.alias("host"), path.alias("path"), F.col(html).alias("_html"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select(key, "host", "path", rule.alias("rule"), verdict.alias("by_rule"), "_html")
    edges = stored(host_edges(rows, "host", "_html"), "edges")
    judged = rows.where("host <> '' and by_rule is not null").groupBy("host").agg(F.count_if(F.col("by_rule") == "allow").alias("good"), F.count_if(F.col("by_rule") == "block").alias("bad"))
    judged = stored(judged, "judged")
    total = judged.agg(F.sum("good"), F.sum("bad")).first()
    good = judged.where("good > 0").select("host", (F.col("good") / F.lit(float(total[0] or 1))).alias("seed"))
    bad = judged.where("bad > 0").select("host", (F.col("bad") / F.lit(float(total[1] or 1))).alias("seed"))
    sides = edges.select(F.lit("trust").alias("side"), "src", "dst", "weight").union(edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "weight"))
    seeds = good.select(F.lit("trust").alias("side"), "host", "seed").union(bad.select(F.lit("distrust"), "host", "seed"))
    ranks = spread(sides, seeds)
    trust = ranks.where("side = 'trust'").select("host", F.col("rank").alias("trust"))
    distrust = ranks.where("side = 'distrust'").select("host", F.col("rank").alias("distrust"))
    verdicts = stored(
        trust.join(distrust, "host", "full").select("host", significant(F.coalesce("trust", F.lit(0.0))).alias("trust"), significant(F.coalesce("distrust", F.lit(0.0))).alias("distrust")),
        "hosts",
    )
    few = F.broadcast(verdicts) if verdicts.count() <= BROADCAST_ROWS else verdicts
    out = rows.drop("_html").join(few, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > ratio * F.col("trust"), "block").otherwise("allow")
    return out.select(key, "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), "trust", "distrust")


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages."""
    return url_filters(read(spark, sf_dir, "pages"))


QUERIES = {"op9_url_filters": op9_url_filters}
ORACLE: dict[str, str] = {}
