"""URL filters: host rules, and verdicts for the rest by propagation over the graph of links.

Method: hosts of urls that allow rules fit are trusted seeds, those that block rules fit are blocked
seeds, each weighted by the share of its pages concerned.  Trust is a personalised PageRank from the
trusted seeds along host edges; distrust is one from the blocked seeds along reversed edges (who links to
a blocked host is suspect).  A host is blocked if distrust makes up more than ``threshold`` of the two.
A host that neither reaches is allowed.

Edges are distinct (from host, to host) with the number of links; links within a host are none.  Every
step joins edges with scores and sums by host (partial sums first); some steps on, the small score table
is written.  Steps go on until scores rest, about 130 of them, however long the paths are.

Defined cases: a null url, or one without "://", has an empty host and path, which no rule fits; a null or
empty html has no links; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import dropped, written

#: Rules are a literal list in the plan; beyond this, split the list by host first.
MOST_RULES = 1000
#: Steps of the propagation that run as one plan.
CHECK = 5


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end."""
    return _ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From the end of the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fitting(rules: list[tuple[str, str]]) -> Column:
    """The longest fitting rule as (length, rule, verdict), or null."""
    assert len(rules) <= MOST_RULES
    each = []
    for verdict, rule in rules:
        host, slash, path = rule.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        each.append(F.when(fits & F.col("path").startswith(slash + path), F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.array_max(F.array(*each)) if each else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts, from href attributes with a host of their own."""
    links = F.expr(r"""regexp_extract_all(html, '(?i)href\\s*=\\s*["\']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"\'\\s>]+)', 1)""")
    each = pages.select(F.col("host").alias("src"), F.explode(links).alias("dst")).select("src", _ascii_lower("dst").alias("dst"))
    return each.filter("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, steps: int = 1000, tolerance: float = 1e-9) -> DataFrame:
    """(kind, host, score) for edges (kind, src, dst, n) and seeds (kind, host, weight).

    For each kind, a PageRank whose jumps, and whose mass at hosts without edges, go back to the seeds: its scores
    are the visits ``seed + damping * moved(visits)`` divided by their sum, so a step is one join and one sum.
    Every CHECK steps visits are written, and compared with those written before, until they differ by less than the
    tolerance in sum.  It is an error if that takes more than so many steps.
    """
    total = seeds.groupBy("kind").agg(F.sum("weight").alias("all"))
    seeds = written(seeds.join(total, "kind").select("kind", "host", (F.col("weight") / F.col("all")).alias("visits")), "seeds")
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = written(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("all")).alias("share")), "edges")
    now = last = seeds
    steps = 0 if edges.isEmpty() else steps
    for step in range(1, steps + 1):
        moved = edges.join(now, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("visits") * F.col("share") * damping).alias("visits"))
        now = seeds.union(moved).groupBy("kind", "host").agg(F.sum("visits").alias("visits"))
        if step % CHECK and step < steps:
            continue
        now = written(now, "scores")
        change = now.withColumnRenamed("visits", "b").join(last, ["kind", "host"], "left").agg(F.sum(F.abs(F.col("b") - F.coalesce("visits", F.lit(0.0))))).first()[0]
        if last is not seeds:
            dropped(last)
        last = now
        if (change or 0) < tolerance:
            break
    else:
        if steps:
            raise RuntimeError(f"scores still change by {change} after {steps} steps")
    visits = now.groupBy("kind").agg(F.sum("visits").alias("all"))
    return now.join(visits, "kind").select("kind", "host", (F.col("visits") / F.col("all")).alias("score"))


def judged(pages: DataFrame, rules: list[tuple[str, str]], threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page."""
    each = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html").withColumn("fit", _fitting(rules))
    verdicts = each.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("by_rule"))
    per_host = written(
        verdicts.groupBy("host").agg(F.count("*").alias("n"), F.count_if(F.col("by_rule") == "allow").alias("allow"), F.count_if(F.col("by_rule") == "block").alias("block")), "hosts"
    ).filter("host <> ''")
    links = written(host_edges(each), "links")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    seed = lambda kind, c: per_host.filter(F.col(c) > 0).select(F.lit(kind).alias("kind"), "host", (F.col(c) / F.col("n")).alias("weight"))
    score = propagated(edges, seed("trust", "allow").union(seed("distrust", "block")))
    both = score.groupBy("host").agg(F.sum(F.when(F.col("kind") == "trust", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "distrust", F.col("score"))).alias("distrust"))
    both = both.select("host", F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    out = verdicts.join(both, "host", "left")
    blocked = F.col("distrust") > threshold * (F.col("trust") + F.col("distrust"))
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(blocked, "block").otherwise("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")
    )
