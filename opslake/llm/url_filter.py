"""URL filters: rules, then link-graph propagation. DataFrame functions only.

A url takes the verdict of its longest fitting rule. Where none fits, its host
decides: trust flows from hosts whose pages the rules allow along links
(personalised PageRank), distrust flows from hosts whose pages the rules block
against the links (a host that links to blocked hosts is suspect), and a host is
blocked when its distrust exceeds its trust by more than ``margin``. A host that
neither reaches is allowed. A seed's weight is the share of its judged pages
that are allowed, or blocked, so a host with both is judged by the larger one.

Scale: links are reduced to host pairs with counts as they leave the scan (a
partial aggregation), so a host with a third of all pages is a few rows a task.
One round is one join and one aggregation over host edges, for both directions at
once; the edges are written once in the shared folder and what a round delivers is
checkpointed. Rounds go on until all that is still to come is below a tenth of ``margin`` in
sum, so no host's score is further from its limit: about 140 rounds for one seed
and 14 more for each tenfold of seeds, or as many as the longest path without
cycles. Rules are a parameter list
(tested up to hundreds), part of the plan and not a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm._common import ascii_lower, read_table, shared_folder, written

DAMPING = 0.85
MAX_ROUNDS = 1_000  # not reached: the rest shrinks by DAMPING each round
ADD_UP_EVERY = 16   # rounds whose deliveries are added up at once
MARGIN = 1e-9
# Fixed values of the contract: rules as (verdict, host/path).
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]
HREF = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>]+)"""


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return ascii_lower(rest)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule (as text) whose host is the url's or a parent of it and
    whose path begins the url's path; of equally long ones the longer host."""
    def fits(rule: str) -> Column:
        at = rule.find("/")
        h, p = (rule[:at], rule[at:]) if at >= 0 else (rule, "")
        return ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))

    order = sorted({r for _, r in rules}, key=lambda r: (-len(r), -len(r.partition("/")[0]), r))
    return F.coalesce(*[F.when(fits(r), F.lit(r)) for r in order], F.lit(None).cast("string"))


def verdict_of(rule: Column, rules: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, r: c.when(rule == r[1], F.lit(r[0])), rules[1:], F.when(rule == rules[0][1], F.lit(rules[0][0])))


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links between different hosts."""
    links = F.regexp_extract_all(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), F.lit(HREF), F.lit(1))
    out = pages.select(host_of(F.col(f"`{url_col}`").cast("string")).alias("src"), links.alias("links"))
    out = out.where((F.size("links") > 0) & (F.col("src") != "")).select("src", F.explode("links").alias("link"))
    full = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), "link")).otherwise(F.col("link"))
    out = out.select("src", host_of(full).alias("dst")).where((F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return out.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, max_rounds: int = MAX_ROUNDS, damping: float = DAMPING,
              tolerance: float = MARGIN) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches.

    ``edges`` is (src, dst, n), ``seeds`` (host, trust, distrust). Personalised
    PageRank from the trust seeds along the edges, and from the distrust seeds
    against them, both from one table of directed flows. Scores are sums of what
    each round delivers; what remains after a round that delivered ``d`` is at
    most ``d * damping / (1 - damping)``, and it ends below ``tolerance``. Raises
    if ``max_rounds`` don't reach that."""
    shared_folder(edges.sparkSession)
    both = edges.select(F.lit("trust").alias("kind"), F.col("src").alias("from"), F.col("dst").alias("to"), "n").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("from"), F.col("src").alias("to"), "n"))
    total = both.groupBy("kind", "from").agg(F.sum("n").alias("total"))
    flow = written(both.join(total, ["kind", "from"]).select(
        "kind", "from", "to", (F.col("n") / F.col("total")).alias("share")), "host-flow")
    start = written(seeds.select(F.explode(F.array(
        F.struct(F.lit("trust").alias("kind"), F.col("host"), F.col("trust").cast("double").alias("x")),
        F.struct(F.lit("distrust").alias("kind"), F.col("host"), F.col("distrust").cast("double").alias("x")))).alias("s"))
        .select("s.*").where("x > 0"), "host-seeds")
    rank = start
    if not flow.isEmpty():
        sums = lambda parts: reduce(DataFrame.unionByName, parts).groupBy("kind", "host").agg(F.sum("x").alias("x"))
        now = start.select("kind", "host", (F.col("x") * (1 - damping)).alias("x"))
        delivered = [now]
        for k in range(1, max_rounds + 1):
            moved = flow.join(now.withColumnRenamed("host", "from"), ["kind", "from"]).select(
                "kind", F.col("to").alias("host"), (F.col("x") * F.col("share") * damping).alias("x"))
            now = moved.groupBy("kind", "host").agg(F.sum("x").alias("x")).checkpoint()
            delivered.append(now)
            if k % ADD_UP_EVERY == 0:
                delivered = [sums(delivered).checkpoint()]
            rest = now.agg(F.coalesce(F.sum("x"), F.lit(0.0))).first()[0] * damping / (1 - damping)
            if rest < tolerance:
                break
        else:
            raise RuntimeError("trust and distrust did not converge")
        rank = sums(delivered)
    return rank.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "trust", F.col("x"))), F.lit(0.0)).alias("trust"),
        F.coalesce(F.sum(F.when(F.col("kind") == "distrust", F.col("x"))), F.lit(0.0)).alias("distrust"))


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], margin: float = MARGIN,
                max_rounds: int = MAX_ROUNDS, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, trust, distrust.

    Defined cases: a null url or one without :// has empty host and path, fits
    no rule and is allowed; null html has no links; null ids and repeated rows
    stay rows (repeated rows count as repeated links); very long pages are read
    whole; an empty table gives an empty result; extra columns are ignored."""
    url = F.col(f"`{url_col}`").cast("string")
    judged = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    judged = judged.withColumn("own", verdict_of(F.col("rule"), rules))
    seeds = judged.where("own IS NOT NULL").groupBy("host").agg(
        F.avg((F.col("own") == "allow").cast("double")).alias("trust"),
        F.avg((F.col("own") == "block").cast("double")).alias("distrust"))
    rank = propagate(written(host_edges(pages, url_col, html_col), "host-edges"), seeds, max_rounds, tolerance=margin / 10)
    bad = F.coalesce(F.col("distrust"), F.lit(0.0)) - F.coalesce(F.col("trust"), F.lit(0.0)) > margin
    return judged.join(rank, "host", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("own", F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "trust", "distrust")


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    """Contract query over the whole pages table."""
    return filter_urls(read_table(spark, sf_dir, "pages"), RULES)
