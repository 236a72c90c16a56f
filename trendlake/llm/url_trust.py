"""URL verdicts from rules and from trust spread over the host link graph.

Rules decide the urls they fit.  For the rest, personalised PageRank carries
trust from hosts with allowed pages along links, and distrust from hosts with
blocked pages against links (who links to a blocked host is suspect).  Both are
thresholded per host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.llm.common import cut


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"),
         Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))

#: Absolute links in html; the host stands in group 1.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``; '' for null or no ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest fitting rule as struct(rule, verdict), else null. Of equal
    lengths the first given wins."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(reversed(rules), key=lambda r: len(r.text)):  # the longest test comes first in the end
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Links between different hosts: ``src, dst, links``, summed before they shuffle."""
    return pages.select(
        url_host(F.col(url_col)).alias("src"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("to"),
    ).select("src", lower_ascii(F.col("to")).alias("dst")).where(
        (F.col("src") != "") & (F.col("src") != F.col("dst"))
    ).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links"))


def spread(edges: DataFrame, seeds: DataFrame, *, damping: float = 0.85, tolerance: float = 1e-4,
           limit: int = 500) -> DataFrame:
    """Personalised PageRank for several seed vectors at once.

    ``edges``: ``kind, src, dst, share`` (shares of one src sum to 1); ``seeds``:
    ``kind, host, seed``. Result ``kind, host, score`` with
    ``score = seed + damping * sum(share * score of the neighbour)``, that is PageRank
    divided by ``1 - damping``, so an unlinked seed keeps its own value. Every step
    is one join and one sum, and is written to the shared folder. Steps end when no score
    moves by ``tolerance``, so that none is off by more than ``damping / (1 - damping)``
    times it; with the default damping that takes 57 steps at most per unit of seed that
    meets in a cycle. ``limit`` steps without an end are an error.
    """
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    for step in range(limit):
        flow = edges.join(scores.withColumnRenamed("host", "src"), ["kind", "src"]).select(
            "kind", F.col("dst").alias("host"), F.lit(0.0).alias("seed"), F.lit(0.0).alias("old"),
            (F.col("share") * F.col("score") * damping).alias("inflow"))
        own = seeds.select("kind", "host", "seed", F.lit(0.0).alias("old"), F.lit(0.0).alias("inflow"))
        before = scores.select("kind", "host", F.lit(0.0).alias("seed"), F.col("score").alias("old"), F.lit(0.0).alias("inflow"))
        after = cut(flow.unionByName(own).unionByName(before).groupBy("kind", "host").agg(
            (F.sum("seed") + F.sum("inflow")).alias("score"), F.sum("old").alias("old")), f"trust-{step}")
        moved = after.agg(F.max(F.abs(F.col("score") - F.col("old")))).first()[0]
        scores = after.drop("old")
        if moved is None or moved < tolerance:
            return scores
    raise RuntimeError(f"scores still move by {moved} after {limit} steps")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, *, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html", damping: float = 0.85, block_at: float = 0.5) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per row of ``pages``.

    A host's seeds are the shares of its pages that rules allow or block. A url
    without a rule is blocked if its host's distrust is at least ``block_at`` and
    above its trust, else allowed. Null urls and urls without ``://`` have an empty
    host, no rule and no links, and are allowed; null html has no links; repeated
    rows and null ids are judged each for itself; other columns are ignored; an
    empty table gives an empty result.
    """
    judged = pages.select(
        F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"),
    ).withColumn("_r", rule_for(F.col("host"), F.col("path"), rules))
    per_host = judged.where(F.col("host") != "").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_r.verdict") == "allow").alias("good"), F.count_if(F.col("_r.verdict") == "block").alias("bad"))
    seeds = cut(per_host.select("host", F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("good") / F.col("n")).alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("bad") / F.col("n")).alias("seed")))).alias("s"),
    ).select("s.kind", "host", "s.seed").where("seed > 0"), "seeds")
    links = cut(host_edges(pages, url_col, html_col), "host-edges")
    both = links.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        links.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    total = both.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    edges = cut(both.join(total, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("share")), "edge-shares")
    scores = spread(edges, seeds, damping=damping).groupBy("host").agg(
        F.coalesce(F.max(F.when(F.col("kind") == "trust", F.col("score"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.max(F.when(F.col("kind") == "distrust", F.col("score"))), F.lit(0.0)).alias("distrust"))
    out = judged.join(scores, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_graph = F.when((distrust >= block_at) & (distrust > trust), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", F.col("_r.rule").alias("rule"),
                      F.coalesce(F.col("_r.verdict"), by_graph).alias("verdict"),
                      trust.alias("trust"), distrust.alias("distrust"))
