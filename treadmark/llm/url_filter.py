"""URL filters: rules by host and path, and trust that runs over the links between hosts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from treadmark.llm.common import LOWER, UPPER, free, only, table
from treadmark.session import durable

#: All seeds of one kind together hold so much; whole numbers, so sums do not depend on their order.
MASS = 10**18
#: Of a hundred parts, those that follow links; the others return to the seeds.
FOLLOW = 85
#: Masses are compared after so many rounds, and have settled when all changes since then add up to less than a millionth of MASS.
STEP = 4
SETTLED = MASS // 10**6


@dataclass(frozen=True)
class UrlRule:
    """``host`` and all its subdomains, below ``path``."""

    verdict: str
    host: str
    path: str


#: Fixed values.
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judged_by_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        best = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(best)
    return best


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, weight: links between hosts, and one link each way between a host and the domain above it."""
    link = r"""(?i)href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""
    links = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(link), F.lit(1)))).alias("to"))
    named = F.translate(F.regexp_extract("to", r"^[^/]*//([^/?#]*)", 1), UPPER, LOWER)  # with a scheme or without
    between = links.select(F.col("host").alias("src"), named.alias("dst")).groupBy("src", "dst").agg(F.count("*").alias("weight"))
    between = durable(between.filter("src <> '' AND dst <> '' AND src <> dst"), "links")
    hosts = pages.select("host").union(between.select("dst")).distinct().filter("host <> ''")
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    chain = hosts.select(above.alias("c")).select(F.explode(F.arrays_zip(F.col("c").alias("a"), F.slice("c", 2, F.size("c")).alias("b"))).alias("e"))
    up = chain.select(F.col("e.a").alias("src"), F.col("e.b").alias("dst")).filter("src <> '' AND dst <> ''").distinct()
    both = up.union(up.select("dst", "src")).withColumn("weight", F.lit(1).cast("long"))
    return between.union(both).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, follow: int = FOLLOW) -> DataFrame:
    """host, allow, block: personalised PageRank of the seeds (host, allow, block) over the edges (src, dst, weight); allow
    follows the edges, block runs against them.

    It takes ``rounds`` rounds, or without them as many as it needs: until a step of STEP rounds reaches no further host
    and changes less than SETTLED in all.  Only these two numbers go to the driver.

    A host gives ``follow`` hundredths of its mass to its edges by weight; the rest comes from the seeds in every round.
    Each edge's part is divided out of the mass itself, so a hub's edges keep theirs at any degree.  Mass of hosts
    without edges is lost, as is what whole-number division leaves: less than one of MASS for an edge.

    Both masses are columns of one row, and an edge is a row at either of its ends, with the weight that it has for each
    mass, so a round is one join and one sum.  The edges are written once; a plan holds STEP rounds and starts from files.
    """
    spark = edges.sparkSession
    zero = F.lit(0).cast("long")
    ways = edges.select("src", "dst", F.col("weight").alias("w_allow"), zero.alias("w_block")).union(
        edges.select("dst", "src", zero, "weight")
    )
    ways = ways.groupBy("src", "dst").agg(F.sum("w_allow").alias("w_allow"), F.sum("w_block").alias("w_block"))
    total = ways.groupBy("src").agg(F.sum("w_allow").alias("t_allow"), F.sum("w_block").alias("t_block"))
    shared = durable(ways.join(total, "src"), "host-edges")
    kinds = ("allow", "block")
    part = [F.expr(f"coalesce(CAST({k} AS DECIMAL(19)) * CAST(w_{k} AS DECIMAL(18)) div nullif(t_{k}, 0), 0L)").alias(k) for k in kinds]
    back = durable(seeds.select("host", *(F.expr(f"CAST(CAST({k} AS DECIMAL(19)) * {100 - follow} div 100 AS BIGINT)").alias(k) for k in kinds)), "back")
    at, k = seeds, 0
    while rounds is None or k < rounds:
        was = at
        for _ in range(STEP if rounds is None else min(STEP, rounds - k)):
            left = at.select(F.col("host").alias("src"), *(F.expr(f"CAST({k_} AS DECIMAL(19)) * {follow} div 100").alias(k_) for k_ in kinds))
            given = left.join(shared, "src").select(F.col("dst").alias("host"), *part)
            at = given.union(back).groupBy("host").agg(*(F.sum(k_).alias(k_) for k_ in kinds)).filter("allow > 0 OR block > 0")
            k += 1
        at = durable(at, "mass")
        if rounds is None:
            signed = at.select("host", "allow", "block", F.lit(1).alias("now")).union(was.select("host", -F.col("allow"), -F.col("block"), F.lit(0)))
            moved = signed.groupBy("host").agg(
                *(F.sum(k_).alias(k_) for k_ in kinds), *(F.max(F.when((F.col("now") == 0) & (F.col(k_) < 0), 1).otherwise(0)).alias(f"old_{k_}") for k_ in kinds)
            )
            change, further = moved.agg(
                F.sum(F.abs("allow").cast("decimal(20)") + F.abs("block").cast("decimal(20)")),
                F.count_if(((F.col("allow") > 0) & (F.col("old_allow") == 0)) | ((F.col("block") > 0) & (F.col("old_block") == 0))),
            ).first()
            free(spark)
            if not further and (change or 0) < SETTLED:
                break
    return at


def url_filter(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, rounds: int | None = None) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.

    A page's verdict is that of the longest rule that fits.  Pages without one get their host's: trust starts at the
    hosts of pages that rules allow and follows the links, distrust starts at the hosts of pages that rules block and runs
    against the links (who links to a blocked host is suspect).  A host with more distrust than trust is blocked.

    A null url, or one without ``://``, has the empty host and path and, as no host is known, is allowed.  A null html
    has no links.  Repeated rows count each; an empty table gives no rows.
    """
    cols = only(pages, "page_id", "url", "html")
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    split = cols.select("page_id", host.alias("host"), path.alias("path"), "html")
    judged = split.select("page_id", "host", "path", judged_by_rule(F.col("host"), F.col("path"), rules).alias("r"))
    judged = durable(judged, "judged")
    ruled = judged.filter("r IS NOT NULL AND host <> ''")
    by_host = durable(ruled.groupBy("host").agg(*(F.count_if(F.col("r.verdict") == k).alias(k) for k in ("allow", "block"))), "seeds")
    total = by_host.agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    mass = lambda k: F.expr(f"CAST(CAST({k} AS DECIMAL(20)) * {MASS} div {max(total[k] or 0, 1)} AS BIGINT)").alias(k)
    seeds = durable(by_host.select("host", mass("allow"), mass("block")), "seed-masses")
    edges = durable(host_edges(split.select("host", "html")), "edges")
    bad = propagate(edges, seeds, rounds).filter("block > allow").select("host", F.lit(True).alias("bad"))
    verdict = F.coalesce("r.verdict", F.when(F.col("bad"), "block").otherwise("allow"))
    return judged.join(bad, "host", "left").select("page_id", "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter(table(spark, folder, "pages"))


def _oracle() -> str:
    lower = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
        for v, h, p in (
            ("allow", "www.example.com", "/en/"), ("block", "example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"), ("allow", "com", "/"),
        )
    )
    return f"""
WITH RECURSIVE p AS (SELECT page_id, {lower.format("regexp_extract(url, '://([^/?#]*)', 1)")} AS host,
   coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, html FROM pages),
 j AS (SELECT *, CASE {fits} END AS r FROM p),
 l AS (SELECT host, unnest(list_distinct(regexp_extract_all(html, 'href\\s*=\\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''\\s>]+)', 1, 'i'))) AS t FROM p),
 b AS (SELECT host AS src, {lower.format("regexp_extract(t, '^[^/]*//([^/?#]*)', 1)")} AS dst, count(*) AS w FROM l GROUP BY 1, 2),
 b2 AS (SELECT * FROM b WHERE src <> '' AND dst <> '' AND src <> dst),
 h AS (SELECT host FROM p WHERE host <> '' UNION SELECT dst FROM b2),
 c AS (SELECT string_split(host, '.') AS s, unnest(range(1, len(string_split(host, '.')))) AS i FROM h),
 u AS (SELECT DISTINCT array_to_string(s[i:], '.') AS src, array_to_string(s[i + 1:], '.') AS dst FROM c),
 u2 AS (SELECT * FROM u WHERE src <> '' AND dst <> ''),
 e AS (SELECT src, dst, sum(w)::BIGINT AS w FROM (SELECT * FROM b2 UNION ALL SELECT src, dst, 1 FROM u2 UNION ALL SELECT dst, src, 1 FROM u2) GROUP BY 1, 2),
 n AS (SELECT host, split_part(r, ' ', 1) AS kind, count(*) AS n FROM j WHERE r IS NOT NULL AND host <> '' GROUP BY 1, 2),
 m0 AS (SELECT kind, host, n::HUGEINT * {MASS} // (sum(n) OVER (PARTITION BY kind))::HUGEINT AS mass FROM n),
 d AS (SELECT kind, src, dst, w, (sum(w) OVER (PARTITION BY kind, src))::HUGEINT AS t
   FROM (SELECT 'allow' AS kind, src, dst, w FROM e UNION ALL SELECT 'block', dst, src, w FROM e)),
 own AS (SELECT kind, host FROM (SELECT src AS host FROM e UNION SELECT dst FROM e UNION SELECT host FROM n), (VALUES ('allow'), ('block')) v(kind)),
 k AS MATERIALIZED (SELECT kind, src, dst, w, t, false AS self, 0::HUGEINT AS back FROM d
   UNION ALL SELECT kind, host, host, 0, 1, true, coalesce(mass * {100 - FOLLOW} // 100, 0) FROM own LEFT JOIN m0 USING (kind, host)),
 m AS (SELECT 0::BIGINT AS round, kind, host, mass, 0::HUGEINT AS was, true AS more FROM m0
   UNION ALL
   SELECT round + 1, kind, host, mass, was,
     (round + 1) % {STEP} <> 0 OR count(*) FILTER (mass > 0 AND was = 0) OVER () > 0 OR sum(abs(mass - was)) OVER () >= {SETTLED}
   FROM (SELECT m.round, k.kind, k.dst AS host, (sum(CASE WHEN self THEN back ELSE (m.mass * {FOLLOW} // 100) * k.w // k.t END))::HUGEINT AS mass,
       (sum(CASE WHEN NOT self THEN 0 WHEN m.round % {STEP} = 0 THEN m.mass ELSE m.was END))::HUGEINT AS was
     FROM m JOIN k ON k.kind = m.kind AND k.src = m.host WHERE m.more GROUP BY m.round, k.kind, k.dst)),
 z AS (SELECT * FROM m WHERE round = (SELECT max(round) FROM m)),
 bad AS (SELECT host FROM z GROUP BY host HAVING sum(CASE WHEN kind = 'block' THEN mass ELSE 0 END) > sum(CASE WHEN kind = 'allow' THEN mass ELSE 0 END))
SELECT page_id, host, path, split_part(r, ' ', 2) AS rule,
  CASE WHEN r IS NOT NULL THEN split_part(r, ' ', 1) WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END AS verdict FROM j"""


ORACLE = _oracle()
