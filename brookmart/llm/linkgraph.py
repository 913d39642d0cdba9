"""URL verdicts: rules first, then trust and distrust along the links of hosts.

Rules decide the urls they fit. Their verdicts are also the seeds of two
personalised PageRanks over hosts: trust starts at pages that rules allow and runs
along links; distrust starts at blocked pages and runs against them, to hosts that
link there. Each is measured against the same walk started at all pages, which
gives the share of a host's mass that comes from seeds, between 0 and 1. A host is
blocked if its distrusted share exceeds its trusted share by ``MARGIN``.

Edges are the links of pages to other hosts, and those between a host and the host
above it (``m.a.org`` and ``a.org``). They are summed per pair of hosts before any
iteration, so a host with very many pages is a few rows. Only DataFrame functions
are used. Iterations are written to the shared folder.

Urls that are null or without ``://`` have an empty host and path; no rule fits,
and without a host nothing is known against them: they are allowed. Null html has
no links. Repeated rows are judged one by one; no rows give none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brookmart.llm.common import column, lower_ascii, stored

# Verdict, host and path of each rule.
RULES = (
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
    ("block", "net", "/"),
)
DAMPING = 0.85
#: Of a host's distrusted over its trusted share.
MARGIN = 0.5
#: What is left of the error in the end; rounds between two writings.
CLOSE, WRITE_EVERY = 1e-2, 7

_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case, and path; both empty without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return lower_ascii(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path in one), and its verdict."""
    found = verdict = F.lit(None).cast("string")
    for what, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit(f".{rule_host}"))) & F.startswith(path, F.lit(rule_path))
        found = F.when(fits, rule_host + rule_path).otherwise(found)
        verdict = F.when(fits, what).otherwise(verdict)
    return found, verdict


def _above(host: Column) -> Column:
    return F.when(F.size(F.split(host, r"\.")) > 2, F.regexp_replace(host, r"^[^.]*\.", ""))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, share) of (host, html) rows; the shares of a src add up to 1."""
    linked = pages.filter("host <> ''").select(
        F.col("host").alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)))).alias("dst"),
    ).select("src", lower_ascii("dst").alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("n"))
    hosts = pages.filter("host <> ''").select("host").distinct()
    up = hosts.select(F.col("host").alias("src"), _above(F.col("host")).alias("dst")).filter("dst IS NOT NULL")
    family = up.unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).select(
        "src", "dst", F.lit(1).cast("long").alias("n"))
    return linked.unionByName(family).filter("src <> dst").groupBy("src", "dst").agg(F.sum("n").alias("n"))


def moves(edges: DataFrame) -> DataFrame:
    """(src, dst, ahead, back): parts of src's mass that go to dst along and against links."""
    ahead = edges.groupBy("src").agg(F.sum("n").alias("total"))
    back = edges.groupBy("dst").agg(F.sum("n").alias("total"))
    zero = F.lit(0.0)
    along = edges.join(ahead, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("ahead"), zero.alias("back"))
    against = edges.join(back, "dst").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), zero.alias("ahead"),
        (F.col("n") / F.col("total")).alias("back"))
    return along.unionByName(against).groupBy("src", "dst").agg(
        F.sum("ahead").alias("ahead"), F.sum("back").alias("back"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, close: float = CLOSE) -> DataFrame:
    """(host, trusted, distrusted): shares of each host's mass that come from seeds.

    ``seeds`` has a row per host: its numbers of pages, trusted and blocked ones.
    Masses are not normalised, so both walks of a pair add up page by page. Each
    round leaves ``damping`` of the error before it, which gives their number.
    """
    marks = ["ahead_all", "ahead_seed", "back_all", "back_seed"]
    every = seeds.select("host").unionByName(edges.select(F.col("src").alias("host"))).unionByName(
        edges.select(F.col("dst").alias("host"))).distinct()
    zero = F.lit(0.0)
    start = stored(every.join(seeds, "host", "left").select(
        "host", *[F.coalesce(F.col(c).cast("double"), zero).alias(m) for c, m in zip(
            ("pages", "trusted", "pages", "blocked"), marks)]), "seeds")
    steps = stored(moves(edges), "moves")
    own = start.select("host", *[(F.col(m) * (1 - damping)).alias(m) for m in marks])
    mass = start
    for k in range(1, 1 + math.ceil(math.log(close) / math.log(damping))):
        sent = mass.join(steps, mass["host"] == steps["src"]).select(
            F.col("dst").alias("host"),
            *[(F.col(m) * F.col("ahead" if m.startswith("ahead") else "back") * damping).alias(m) for m in marks])
        mass = own.unionByName(sent).groupBy("host").agg(*[F.sum(m).alias(m) for m in marks])
        if k % WRITE_EVERY == 0:
            mass = stored(mass, "mass")
    mass = stored(mass, "mass")
    part = lambda seed, whole: F.coalesce(F.try_divide(F.col(seed), F.col(whole)), zero)
    return mass.select("host", part("ahead_seed", "ahead_all").alias("trusted"),
                       part("back_seed", "back_all").alias("distrusted"))


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          rules=RULES, margin: float = MARGIN) -> DataFrame:
    """One row per row of ``pages``: parts of its url, the rule that fits, the verdict."""
    host, path = url_parts(column(pages, url_col).cast("string"))
    parted = pages.select(column(pages, id_col).alias("page_id"), host.alias("host"), path.alias("path"),
                          column(pages, html_col).cast("string").alias("html"))
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    parted = parted.select("page_id", "host", "path", rule.alias("rule"), ruled.alias("ruled"), "html")
    seeds = parted.filter("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("ruled") == "allow").alias("trusted"),
        F.count_if(F.col("ruled") == "block").alias("blocked"))
    edges = stored(host_edges(parted.select("host", "html")), "edges")
    scores = propagate(seeds, edges).withColumn(
        "bad", F.col("distrusted") - F.col("trusted") > margin)
    return parted.drop("html").join(scores, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("ruled", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trusted", F.lit(0.0)).alias("trusted"), F.coalesce("distrusted", F.lit(0.0)).alias("distrusted"))
