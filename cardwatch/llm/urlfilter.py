"""URL filter: listed rules first, then trust and distrust spread over the links between hosts.

Personalised PageRank carries trust from the hosts of allowed pages along their links, and distrust
from the hosts of blocked pages against the direction of links (who links to blocked pages is
suspect). A host is judged by comparing its two shares. Everything is DataFrame and SQL functions.
"""
from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.common import ascii_lower, table
from cardwatch.session import checkpointed, saved


class Rule(NamedTuple):
    action: str  # allow or block
    host: str
    path: str


#: Fixed values of the query contract.
RULES = [
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
]

LINK = r"""(?i)\bhref\s*=\s*["']?([^"'\s>]+)"""
#: A share is settled when a round adds less than this part of it; shares nearer than MARGIN (a part, too) are even.
DAMPING, TOLERANCE, MARGIN = 0.85, 1e-6, 1e-6
#: The SQL cannot iterate until shares settle: its rounds, and its margin on shares that sum to 1.
SQL_ROUNDS, SQL_MARGIN = 20, 1e-6


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (lower case) and path of a URL; both empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.split(url, "://", 2)[1]).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits, null without one; block wins a tie."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.action == "block")):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text = F.when(fits, r.host + r.path).otherwise(text)
        action = F.when(fits, r.action).otherwise(action)
    return text, action


def host_links(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """src, dst, n: links between different hosts. A relative link stays on its host."""
    link = F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))
    absolute = pages.filter(F.col(html).contains("//")).select(F.col(host).alias("src"), link.alias("_link"))
    absolute = absolute.filter(F.col("_link").rlike(r"^([a-zA-Z][a-zA-Z0-9+.-]*:)?//"))
    dst = host_and_path(F.concat(F.lit("x"), F.regexp_extract("_link", r"(://.*)$", 1)))[0]
    bare = host_and_path(F.concat(F.lit("x:"), F.col("_link")))[0]
    dst = F.when(F.col("_link").startswith("//"), bare).otherwise(dst)
    return (absolute.select("src", dst.alias("dst"))
            .filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
            .groupBy("src", "dst").agg(F.count("*").alias("n")))


def spread(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """Personalised PageRank of several kinds at once: kind, host, share (sums to 1 in a kind).

    edges: kind, src, dst, n. seeds: kind, host, mass (any scale). Mass of hosts without links is
    not handed on; that changes the scale only, and shares are scaled at the end. Rounds go on until
    the share of every host is settled in proportion to itself, so all hosts that links reach have
    one, and neither the size of the graph nor the distance to a seed decides. Ranks only grow, and
    what a round adds shrinks by ``damping``: about 90 rounds, or the longest way from a seed if longer.
    """
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("all"))
    seeds = saved(seeds.join(total, "kind").filter("mass > 0")
                  .select("kind", "host", (F.col("mass") / F.col("all")).alias("seed")), "seeds")
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("all"))
    edges = saved(edges.join(out, ["kind", "src"])
                  .select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("all")).alias("w")), "edges")
    base = seeds.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
    rank, open_ = base, not edges.isEmpty()
    nothing = F.lit(0.0).alias("old")
    while open_:
        flow = rank.join(edges, ["kind", "host"]).select(
            "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("w") * damping).alias("rank"), nothing)
        both = flow.unionByName(base.select("*", nothing)).unionByName(
            rank.select("kind", "host", F.lit(0.0).alias("rank"), F.col("rank").alias("old")))
        new = checkpointed(both.groupBy("kind", "host").agg(F.sum("rank").alias("rank"), F.sum("old").alias("old")))
        open_ = not new.filter(F.col("rank") - F.col("old") > tolerance * F.col("rank")).isEmpty()
        rank = new.drop("old")
    whole = rank.groupBy("kind").agg(F.sum("rank").alias("all"))
    return rank.join(whole, "kind").select("kind", "host", (F.col("rank") / F.col("all")).alias("share"))


def judge(pages: DataFrame, rules: list[Rule] = RULES, page_id: str = "page_id", url: str = "url",
          html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust of every row.

    A page with a rule gets the rule's action. Any other page is blocked where its host's share of
    all distrust exceeds its share of all trust, else allowed; unknown hosts and empty URLs have
    neither and are allowed. Null html has no links; repeated rows count as repeated pages; other
    columns are ignored. An empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    text, action = matching_rule(F.col("host"), F.col("path"), rules)
    read = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"),
                        F.col(html).alias("html"))
    ruled = read.withColumns({"rule": text, "action": action})
    seeds = (ruled.filter("action IS NOT NULL AND host != ''").groupBy("action", "host")
             .agg(F.count("*").alias("mass")).withColumnRenamed("action", "kind"))
    links = saved(host_links(read), "links")
    edges = links.select(F.lit("allow").alias("kind"), "src", "dst", "n").unionByName(
        links.select(F.lit("block").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"))
    share = (spread(edges, seeds).groupBy("host")
             .agg(F.sum(F.when(F.col("kind") == "allow", F.col("share"))).alias("trust"),
                  F.sum(F.when(F.col("kind") == "block", F.col("share"))).alias("distrust")))
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    return (ruled.drop("html").join(share, "host", "left")
            .withColumns({"trust": trust, "distrust": distrust})
            .select("page_id", "host", "path", "rule",
                    F.coalesce("action", F.when(F.col("distrust") > F.col("trust") * (1 + MARGIN), "block")
                               .otherwise("allow")).alias("verdict"), "trust", "distrust"))


def op8_url_filter(spark, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages")).select("page_id", "host", "path", "rule", "verdict")


def _sql() -> str:
    host = ("CASE WHEN instr(url,'://')>0 THEN translate(regexp_extract(substr(url,instr(url,'://')+3),'^[^/?#]*'),"
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz') ELSE '' END")
    path = ("CASE WHEN instr(url,'://')>0 THEN regexp_extract(substr(url,instr(url,'://')+3),"
            "'^[^/?#]*([^?#]*)',1) ELSE '' END")
    rounds = "".join(
        f", r{i} AS (SELECT kind, host, sum(rank) AS rank FROM (SELECT r.kind, e.dst AS host, {DAMPING} * r.rank * e.w AS rank"
        f" FROM r{i - 1} r JOIN w e ON r.kind = e.kind AND r.host = e.src UNION ALL SELECT * FROM r0) GROUP BY 1, 2)"
        for i in range(1, SQL_ROUNDS + 1))
    return f"""
WITH p AS (SELECT page_id, {host} AS host, {path} AS path, html FROM pages),
rules(action, rh, rp) AS (VALUES ('allow','org','/'), ('block','example.org','/es/'),
  ('block','example.org','/en/1'), ('allow','com','/fr/'), ('block','com','/de/')),
m AS (SELECT p.page_id, host, path, arg_max(rh || rp, length(rh || rp)) AS rule,
      arg_max(action, length(rh || rp)) AS action
      FROM p LEFT JOIN rules ON (host = rh OR host LIKE '%.' || rh) AND starts_with(path, rp) GROUP BY ALL),
a AS (SELECT host AS src, unnest(regexp_extract_all(html, 'href="([^"]+)"', 1)) AS link FROM p),
e AS (SELECT src, translate(regexp_extract(link, '//([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz') AS dst, count(*) AS n FROM a
      WHERE regexp_matches(link, '^([a-zA-Z][a-zA-Z0-9+.-]*:)?//') GROUP BY 1, 2),
d AS (SELECT 'allow' AS kind, src, dst, n FROM e WHERE src != '' AND dst != '' AND src != dst
      UNION ALL SELECT 'block', dst, src, n FROM e WHERE src != '' AND dst != '' AND src != dst),
w AS (SELECT kind, src, dst, n / sum(n) OVER (PARTITION BY kind, src) AS w FROM d),
s AS (SELECT action AS kind, host, count(*) AS mass FROM m WHERE action IS NOT NULL AND host != '' GROUP BY 1, 2),
r0 AS (SELECT kind, host, {1 - DAMPING} * mass / sum(mass) OVER (PARTITION BY kind) AS rank FROM s){rounds},
sh AS (SELECT host, coalesce(max(x) FILTER (kind = 'allow'), 0) AS t, coalesce(max(x) FILTER (kind = 'block'), 0) AS d
       FROM (SELECT kind, host, rank / sum(rank) OVER (PARTITION BY kind) AS x FROM r{SQL_ROUNDS}) GROUP BY 1)
SELECT page_id, m.host, path, rule,
  coalesce(action, CASE WHEN coalesce(d, 0) > coalesce(t, 0) + {SQL_MARGIN} THEN 'block' ELSE 'allow' END) AS verdict
FROM m LEFT JOIN sh ON m.host = sh.host"""


SQL = _sql()
