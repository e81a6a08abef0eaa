"""Operator 8: URL rules and link-graph propagation over hosts, native SQL functions only.

Hosts with pages that a rule allows are trusted seeds, hosts with blocked pages distrusted
ones.  Trust spreads by personalised PageRank along host edges (links in the pages),
distrust by the same walk on reversed edges.  A page without a rule takes its host's
verdict: block where distrust holds at least ``threshold`` of its host's total mass.
Both walks run until they settle, however long the chains of links are; only mass under the
smallest double (on a single chain, after some 4,500 links) counts as none.

Edge cases: NULL urls and urls without ``://`` have empty host and path; NULL html has no
links; repeated rows weigh as often as they occur; hosts without mass are allowed; an empty
table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..names import col as named
from .common import ascii_lower, materialize

#: Fixed values of the judged rule set: (verdict, host, path prefix).
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
HREF = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def with_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule and rule_verdict: the longest rule whose host and path prefix fit."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, kind, share): out-link shares for trust, the reversed edges for distrust."""
    links = pages.select(F.col("host").alias("src"), F.explode(F.regexp_extract_all(
        "html", F.lit(HREF), F.lit(1))).alias("href")).groupBy("src", "href").agg(
        F.count("*").alias("n"))
    absolute = F.when(F.col("href").startswith("//"), F.concat(F.lit("x:"), "href")).otherwise(F.col("href"))
    edges = materialize(links.withColumn("dst", host_of(absolute)).filter("dst <> '' AND dst <> src")
                        .groupBy("src", "dst").agg(F.sum("n").alias("n")), "link-edges")
    both = edges.select("src", "dst", F.lit("trust").alias("kind"), "n").union(
        edges.select("dst", "src", F.lit("distrust"), "n"))
    total = both.groupBy(F.col("src").alias("from"), F.col("kind").alias("of")).agg(F.sum("n").alias("all"))
    return materialize(
        both.join(total, (F.col("src") == F.col("from")) & (F.col("kind") == F.col("of")))
        .select("src", "dst", "kind", (F.col("n") / F.col("all")).alias("share")), "link-shares")


def propagate(seeds: DataFrame, edges: DataFrame, *, damping: float = 0.85, tolerance: float = 1e-6,
              cut_every: int = 5) -> DataFrame:
    """(host, kind, mass) of both personalised walks; seeds sum to one.

    Every round adds what the round before moved on (``step``).  The walk ends when no host's
    mass grew by more than ``tolerance`` of itself; a host reached for the first time grows
    by its whole mass, so none is left out.  The test is made every ``cut_every`` rounds.
    """
    state, k = seeds.withColumn("mass", F.col("mass") * (1 - damping)).withColumn("step", F.col("mass")), 0
    while True:
        k += 1
        moved = state.filter("step > 0").join(
            edges, (state["host"] == edges["src"]) & (state["kind"] == edges["kind"])).select(
            F.col("dst").alias("host"), state["kind"], (F.col("step") * F.col("share") * damping).alias("mass"))
        state = state.withColumn("step", F.lit(0.0)).union(moved.withColumn("step", F.col("mass"))).groupBy(
            "host", "kind").agg(F.sum("mass").alias("mass"), F.sum("step").alias("step"))
        if k % cut_every == 0:
            state = materialize(state, f"link-mass-{k}")
            if state.filter(F.col("step") > tolerance * F.col("mass")).isEmpty():
                return state.drop("step")


def judge(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES, threshold: float = 0.75, **walk) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's trust and distrust."""
    url = named(url_col)
    found = with_rules(pages.select(named(id_col).alias("page_id"), host_of(url).alias("host"),
                                    path_of(url).alias("path"), named(html_col).alias("html")), rules)
    votes = found.filter("rule_verdict IS NOT NULL").groupBy("host", F.when(
        F.col("rule_verdict") == "allow", "trust").otherwise("distrust").alias("kind")).agg(
        F.count("*").alias("n"))
    votes = materialize(votes, "link-votes")
    total = F.broadcast(votes.groupBy(F.col("kind").alias("of")).agg(F.sum("n").alias("all")))  # two rows
    seeds = materialize(votes.join(total, F.col("kind") == F.col("of")).select(
        "host", "kind", (F.col("n") / F.col("all")).alias("mass")), "link-seeds")
    mass = propagate(seeds, host_edges(found), **walk)
    hosts = materialize(mass.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("mass"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("mass"))).alias("distrust"))
        .fillna(0.0), "link-hosts").withColumnRenamed("host", "at")
    bad = (F.col("distrust") > 0) & (F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust")))
    judged = found.select("page_id", "host", "path", "rule", "rule_verdict").join(
        hosts, F.col("host") == F.col("at"), "left")
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
