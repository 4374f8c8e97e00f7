"""URL filters: explicit rules first, then trust and distrust spread over the graph of links between hosts.

Trust starts at hosts with allowed pages and follows the links (personalised PageRank); distrust starts at hosts with
blocked pages and follows the links backwards, so it reaches those who link to them.  A host is blocked where distrust
outweighs trust.  Everything is joins and sums over host edges; a page with many links only adds to counts.

Cases: a NULL URL, or one without ``://``, has an empty host and path, fits no rule and is allowed; NULL or empty html
has no links; hosts that neither spread reaches are allowed; repeated rows are judged one by one, and their links
counted as often; without seeds, links or rows nothing spreads; further columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from posttrend.llm.common import LOWER, UPPER, ascii_lower
from posttrend.session import cut_lineage


class UrlRule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values.
RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
DAMPING = 0.85
ROUNDS = 12  # what the SQL writes out; the spread itself goes on until it settles
TOLERANCE = 1e-9  # of a host's own rank, so that the size of the graph does not matter
MARGIN = 1e-6  # distrust must be larger than trust by this share of it
MOST_ROUNDS = 1000
# A tag ends at the next ``<`` at the latest, so that an unclosed one is not read on to the end of the page.
LINK = r"""(?i)<a\s(?:[^<>]*?\s)?href\s*=\s*["']?\s*([^"'\s>]+)"""


def _after_scheme(url: Column) -> Column:
    """NULL where there is no ``://``."""
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_length(rules) -> list[UrlRule]:
    return sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.text))


def match_rule(host: Column, path: Column, rules=RULES) -> Column:
    """Struct of the longest fitting rule's text and verdict, or NULL."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(_by_length(rules)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links`` between different hosts, for links that name a host."""
    links = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("link"),
    )
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    edges = links.where(F.col("link").rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//")).select("src", host_of(full).alias("dst"))
    return edges.where("src <> '' AND dst <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def _flow(edges: DataFrame) -> DataFrame:
    """``kind, host, to, share``: how a host's trust follows its links, and distrust the links to it."""
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "links")
    )
    out = both.groupBy("kind", "host").agg(F.sum("links").alias("all_links"))
    return cut_lineage(both.join(out, ["kind", "host"]).select("kind", "host", "to", (F.col("links") / F.col("all_links")).alias("share")))


def settle(
    edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """``kind, host, rank`` that ``propagate`` comes ever closer to.

    As what leaves through no link goes back to the seeds, the settled ranks are in proportion to the sum of all that
    arrives over 0, 1, 2, ... links from the seeds.  A step goes one link further, until what arrives anywhere is less
    than ``tolerance`` of the rank the host has by then; without cycles that is the longest path.  From there on every
    further step stays below that share too, whatever the number of hosts.
    """
    flow = _flow(edges)
    ranks = cut_lineage(seeds.select("kind", "host", F.col("seed").alias("step"), F.col("seed").alias("rank")))
    for _ in range(most_rounds):
        moved = flow.join(ranks.where("step > 0"), ["kind", "host"]).select(
            "kind", F.col("to").alias("host"), (F.col("step") * F.col("share") * damping).alias("step"), F.lit(0.0).alias("rank")
        )
        parts = moved.unionByName(ranks.select("kind", "host", F.lit(0.0).alias("step"), "rank"))
        sums = parts.groupBy("kind", "host").agg(F.sum("step").alias("step"), F.sum("rank").alias("rank"))
        ranks = cut_lineage(sums.withColumn("rank", F.col("rank") + F.col("step")))
        if (ranks.agg(F.max(F.try_divide("step", "rank"))).first()[0] or 0.0) < tolerance:
            break
    else:
        raise RuntimeError("trust and distrust did not settle")
    total = ranks.groupBy("kind").agg(F.sum("rank").alias("all"))  # two rows at most
    return ranks.join(F.broadcast(total), "kind").select("kind", "host", (F.col("rank") / F.col("all")).alias("rank"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """``kind, host, rank``, settled, or after ``rounds`` steps if they are given.

    ``seeds``: ``kind`` (trust or distrust), ``host``, ``seed``, adding up to 1 per kind.  Rank that leaves through no
    link goes back to the seeds.
    """
    if rounds is None:
        return settle(edges, seeds, damping)
    flow = _flow(edges)
    seeds = cut_lineage(seeds)
    ranks = seeds.select("kind", "host", F.col("seed").alias("rank"))
    for _ in range(rounds):
        moved = flow.join(ranks, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(
            F.sum(F.col("rank") * F.col("share")).alias("moved")
        )
        moved = cut_lineage(moved)
        arrived = {r["kind"]: r["all"] for r in moved.groupBy("kind").agg(F.sum("moved").alias("all")).collect()}  # two rows at most
        lost = F.lit(0.0)
        for kind in ("trust", "distrust"):
            lost = F.when(F.col("kind") == kind, F.lit(1.0 - arrived.get(kind, 0.0))).otherwise(lost)
        back = seeds.select("kind", "host", (F.col("seed") * (F.lit(1 - damping) + F.lit(damping) * lost)).alias("part"))
        parts = back.unionByName(moved.select("kind", "host", (F.col("moved") * damping).alias("part")))
        before = ranks
        ranks = cut_lineage(parts.groupBy("kind", "host").agg(F.sum("part").alias("rank")))
        if not arrived:
            break
        change = ranks.join(before.withColumnRenamed("rank", "old"), ["kind", "host"], "full").agg(
            F.max(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0)))).alias("most")
        )
        if (change.first()["most"] or 0.0) < 1e-12:
            break
    return ranks


def host_scores(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """``host, trust, distrust, blocked`` for every host that either spread reaches."""
    judged = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.select("host", match_rule(F.col("host"), F.col("path"), rules)["verdict"].alias("verdict"))
    counts = judged.where("verdict IS NOT NULL").groupBy(
        F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host"
    ).agg(F.count("*").alias("pages"))
    total = counts.groupBy("kind").agg(F.sum("pages").alias("all_pages"))
    seeds = counts.join(F.broadcast(total), "kind").select("kind", "host", (F.col("pages") / F.col("all_pages")).alias("seed"))  # two rows
    ranks = propagate(host_edges(pages), seeds, damping, rounds)
    sums = ranks.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"),
    )
    return sums.withColumn("blocked", F.col("distrust") > F.col("trust") * (1 + MARGIN))


def filter_urls(pages: DataFrame, rules=RULES, damping: float = DAMPING, rounds: int | None = None) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``; ``verdict`` is the rule's, else that of the host."""
    blocked = host_scores(pages, rules, damping, rounds).where("blocked").select(F.col("host").alias("bad_host"))
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = judged.withColumn("found", match_rule(F.col("host"), F.col("path"), rules))
    judged = judged.join(blocked, F.col("host") == F.col("bad_host"), "left")
    method = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("found")["rule"].alias("rule"),
        F.coalesce(F.col("found")["verdict"], method).alias("verdict"),
    )


def oracle() -> str:
    """The same steps in SQL, the rounds written out one after the other."""
    host = f"translate(regexp_extract(substr(%s, instr(%s, '://') + 3), '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    url_host = "CASE WHEN instr(url, '://') > 0 THEN " + host.replace("%s", "url") + " ELSE '' END"
    path = r"CASE WHEN instr(url, '://') > 0 THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END"
    fits = [
        (f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')", r) for r in _by_length(RULES)
    ]
    rule = "CASE " + " ".join(f"WHEN {t} THEN '{r.text}'" for t, r in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {t} THEN '{r.verdict}'" for t, r in fits) + " END"
    ctes = [
        f"p AS (SELECT page_id, html, coalesce({url_host}, '') AS host, coalesce({path}, '') AS path FROM pages)",
        f"j AS (SELECT page_id, host, path, {rule} AS rule, {verdict} AS v FROM p)",
        "c AS (SELECT CASE v WHEN 'allow' THEN 'trust' ELSE 'distrust' END AS kind, host, count(*) AS n FROM j WHERE v IS NOT NULL GROUP BY 1, 2)",
        "seed AS (SELECT kind, host, n / sum(n) OVER (PARTITION BY kind) AS seed FROM c)",
        "l AS (SELECT host AS src, unnest(regexp_extract_all(html, '" + LINK.replace("'", "''") + "', 1)) AS link FROM p)",
        "f AS (SELECT src, CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END AS link FROM l "
        "WHERE regexp_matches(link, '^([A-Za-z][A-Za-z0-9+.-]*:)?//'))",
        "h AS (SELECT src, " + host.replace("%s", "link") + " AS dst FROM f)",
        "e AS (SELECT src, dst, count(*) AS n FROM h WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY 1, 2)",
        "b AS (SELECT 'trust' AS kind, src AS host, dst AS goal, n FROM e UNION ALL SELECT 'distrust', dst, src, n FROM e)",
        "flow AS (SELECT kind, host, goal, n / sum(n) OVER (PARTITION BY kind, host) AS share FROM b)",
        "r0 AS (SELECT kind, host, seed AS rank FROM seed)",
    ]
    for k in range(ROUNDS):
        ctes += [
            f"m{k} AS (SELECT kind, goal AS host, sum(rank * share) AS moved FROM flow JOIN r{k} USING (kind, host) GROUP BY 1, 2)",
            f"t{k} AS (SELECT kind, sum(moved) AS arrived FROM m{k} GROUP BY 1)",
            f"r{k + 1} AS (SELECT kind, host, sum(part) AS rank FROM (SELECT kind, host, seed * ({1 - DAMPING!r} + {DAMPING} * "
            f"(1 - coalesce(arrived, 0))) AS part FROM seed LEFT JOIN t{k} USING (kind) UNION ALL "
            f"SELECT kind, host, moved * {DAMPING} FROM m{k}) GROUP BY 1, 2)",
        ]
    ctes.append(
        "bad AS (SELECT host FROM (SELECT host, sum(CASE kind WHEN 'trust' THEN rank ELSE 0 END) AS trust, "
        f"sum(CASE kind WHEN 'trust' THEN 0 ELSE rank END) AS distrust FROM r{ROUNDS} GROUP BY 1) "
        f"WHERE distrust > trust * {1 + MARGIN!r})"
    )
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT page_id, j.host, path, rule, "
        "coalesce(v, CASE WHEN bad.host IS NULL THEN 'allow' ELSE 'block' END) AS verdict FROM j LEFT JOIN bad USING (host)"
    )
