"""URL filtering: host and path rules, and for the rest trust and distrust spread over the link graph of hosts.

Trust is a personalised PageRank that starts from hosts with allowed pages and follows links; distrust starts from hosts
with blocked pages and follows links backwards (a host that links to blocked ones is distrusted). Both count pages, so they
can be compared; a host is blocked when its distrust is above its trust.
"""

from __future__ import annotations

import math
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverlog.llm.common import lower_ascii, stored, table

#: The rules of the contract: (verdict, host, path). Fixed values.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
PARSE = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: A link that names its host, with or without a scheme, and that host.
LINK = r"""(?i)\shref\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
LINK_HOST = r"^[^/]*//([^/?#]*)"
#: SETTLED: growth of a score in one round, as a share of it, that ends the rounds.
DAMPING, CUT_EVERY, SETTLED = 0.85, 4, 1e-9
#: Distrust over trust from which a host is blocked.
BLOCK_RATIO = 1.0


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(F.coalesce(url, F.lit("")), PARSE, 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARSE, 2)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest fitting rule, or null. One expression: rules are an argument, not data."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight (links between two different hosts), summed before the shuffle."""
    links = pages.select(host_of(F.col("url")).alias("src"), F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("to"))
    return links.select("src", lower_ascii(F.regexp_extract("to", LINK_HOST, 1)).alias("dst")).where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, settled: float = SETTLED) -> DataFrame:
    """host, trust, distrust from seeds(host, trust, distrust) over edges(src, dst, weight).

    Rounds go on until in one of them no score of any host grew by more than `settled` of itself, so hosts far from every seed
    are reached too, and small scores are as precise as large ones. Scores under the least normal double (2e-308) count as none.
    """
    total = lambda k: edges.groupBy(k).agg(F.sum("weight").alias("all"))
    links = edges.join(total("src").withColumnRenamed("all", "out"), "src").join(total("dst").withColumnRenamed("all", "in"), "dst")
    forward = F.struct(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("weight") / F.col("out")).alias("share"))
    back = F.struct(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), (F.col("weight") / F.col("in")).alias("share"))
    shares = stored(links.select(F.inline(F.array(forward, back))), "host-links")
    if shares.isEmpty():
        return seeds.select("host", ((1 - damping) * F.col("trust")).alias("trust"), ((1 - damping) * F.col("distrust")).alias("distrust"))
    each = F.array(*[F.struct(F.lit(k).alias("kind"), ((1 - damping) * F.col(k)).alias("score")) for k in ("trust", "distrust")])
    base = stored(seeds.select("host", F.inline(each)).where("score > 0"), "host-seeds")
    # Round k adds at most damping^k of the seeds' mass anywhere: after so many rounds every score has settled.
    least = sys.float_info.min
    rounds = math.ceil((math.log(least) + math.log(settled) - math.log(base.agg(F.sum("score")).first()[0] or 1.0)) / math.log(damping)) + CUT_EVERY
    score = base
    for k in range(1, rounds + 1):
        flow = score.withColumnRenamed("host", "from").join(shares, ["kind", "from"]).select(F.col("to").alias("host"), "kind", (damping * F.col("score") * F.col("share")).alias("score"))
        new = base.unionByName(flow)
        if k % CUT_EVERY:
            score = new.groupBy("host", "kind").agg(F.sum("score").alias("score"))
            continue
        parts = new.withColumn("before", F.lit(0.0)).unionByName(score.select("host", "kind", F.lit(0.0).alias("score"), F.col("score").alias("before")))
        score = stored(parts.groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("before").alias("before")), "host-scores")
        moved = F.abs(F.col("score") - F.col("before"))
        if score.where((moved > settled * F.col("score")) & (moved >= least)).isEmpty():
            of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
            return score.groupBy("host").agg(of("trust"), of("distrust"))
        score = score.drop("before")
    raise RuntimeError(f"host scores have not settled in {rounds} rounds")


def judged(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, r (the fitting rule and its verdict, or null)."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]], block_ratio: float = BLOCK_RATIO) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for each row of pages(page_id, url, html).

    Other columns are not read. A null url or one without "://" has empty host and path, no rule and no links; like a host
    that neither seeds nor links reach, it is allowed. A null html has no links. Repeated rows are each judged and counted; no
    rows give no rows.
    """
    rows = judged(pages, rules)
    count = lambda v: F.count_if(F.col("r.verdict") == v).cast("double").alias("trust" if v == "allow" else "distrust")
    seeds = rows.where("host <> ''").groupBy("host").agg(count("allow"), count("block"))
    scores = propagate(seeds, host_edges(pages)).where("trust > 0 OR distrust > 0")
    spread = rows.join(scores, "host", "left").na.fill(0.0, ["trust", "distrust"])
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("distrust") > block_ratio * F.col("trust"), "block").otherwise("allow"))
    return spread.select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules alone say of each page; verdict is null where the link graph decides."""
    return judged(table(spark, sf_dir, "pages"), RULES).select("page_id", "host", "path", "r.rule", "r.verdict")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), RULES)


#: Of the rules only.
ORACLE = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
l(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f AS (SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(l.verdict, length(h || p)) AS verdict FROM u LEFT JOIN l ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY ALL)
SELECT page_id, host, path, rule, verdict FROM f
"""

QUERIES = {"op9_url_filter": op9_url_filter, "url_rules": url_rules}
ORACLES = {"url_rules": ORACLE}
