"""URL filters: path rules of hosts first, then trust and distrust spread over links between hosts.

Column expressions and joins only.
"""

from __future__ import annotations

from math import ceil, log

from pyspark.sql import Column, DataFrame, functions as F

from corpusmap.llm.common import fresh
from corpusmap.session import cut_lineage, discard

A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DAMPING, THRESHOLD = 0.85, 1e-9
#: How much of all trust and distrust together may not have moved at the end of the walks; under the threshold.
TOLERANCE = 1e-10
#: Steps of the SQL, which cannot go on until the rest is small.
STEPS = 10

Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://`` or url."""
    return F.coalesce(F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), A_TO_Z, A_TO_Z.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``rule`` and ``verdict`` of the longest rule that fits, else nulls.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, host: Column, html_col: str = "html") -> DataFrame:
    """``a, b, n``: how many links lead from pages of host ``a`` to another host ``b``."""
    target = F.expr(f"regexp_extract_all(`{html_col}`, '(?i)href\\\\s*=\\\\s*[\"\\']?(?:https?:)?//([^/?#\"\\'\\\\s>]+)', 1)")
    return (
        pages.select(host.alias("a"), F.explode(target).alias("b"))
        .withColumn("b", F.translate("b", A_TO_Z, A_TO_Z.lower()))
        .filter("a <> b and a <> ''").groupBy("a", "b").agg(F.count("*").alias("n"))
    )


def spread(links: DataFrame, seeds: DataFrame, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """``host, trust, distrust`` after personalised PageRank from ``host, trusted, blocked`` seeds.

    Trust follows links from the trusted seeds; distrust goes against them from the blocked ones, so
    a host that links to blocked hosts is suspect. Both walks share each step: one join on the host,
    one sum that combines before its shuffle. They go on until what has not moved, over all hosts, is at most
    ``tolerance``: after n steps that is at most ``damping ** (n + 1)`` of the seeds, and at most
    ``damping / (1 - damping)`` of the last change, so the walks end early where links run out.
    """
    restart = seeds.selectExpr("host", "stack(2, 0, trusted, 1, blocked) as (kind, seed)").filter("seed > 0")
    state = cut_lineage(restart.select("host", "kind", ((1 - damping) * F.col("seed")).alias("score")))
    ways = links.selectExpr("stack(2, 0, a, b, 1, b, a) as (kind, host, onto)", "n")
    total = ways.groupBy("kind", "host").agg(F.sum("n").alias("total"))
    ways = cut_lineage(ways.join(total, ["kind", "host"]).select("kind", "host", "onto", (F.col("n") / F.col("total")).alias("share")))
    mass = restart.agg(F.sum("seed")).first()[0] or 0.0
    most = max(0, ceil(log(tolerance / mass) / log(damping))) if mass > tolerance else 0
    again = restart.select("host", "kind", ((1 - damping) * F.col("seed")).alias("score"), F.lit(0.0).alias("old"))
    for _ in range(0 if ways.isEmpty() else most):
        moved = ways.join(state, ["kind", "host"]).select(
            F.col("onto").alias("host"), "kind", (damping * F.col("score") * F.col("share")).alias("score"), F.lit(0.0).alias("old")
        )
        last = state.select("host", "kind", F.lit(0.0).alias("score"), F.col("score").alias("old"))
        before = state
        state = cut_lineage(moved.unionByName(again).unionByName(last).groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("old").alias("old")))
        discard(before)
        if state.agg(F.sum(F.abs(F.col("score") - F.col("old")))).first()[0] * damping <= tolerance * (1 - damping):
            break
    one = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return state.groupBy("host").agg(one(0).alias("trust"), one(1).alias("distrust"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], url_col: str = "url", html_col: str = "html", threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE, damping: float = DAMPING,
) -> DataFrame:
    """``pages`` with a column ``url_verdict``: host, path, rule, verdict, trust and distrust.

    The longest fitting rule decides. Hosts seed the walks with the shares of their pages that rules
    allow and block; where no rule fits, a host whose distrust exceeds its trust by more than
    ``threshold`` is blocked, any other allowed. Null urls and urls without ``://`` have an empty host and path, fit no
    rule and are allowed; null pages have no links; repeated rows count as they stand. A column named ``url_verdict`` is replaced,
    others stay.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    found = F.struct(host.alias("host"), path.alias("path"), longest_rule(host, path, rules).alias("fit"))
    at, known_at = fresh("url_found", pages), fresh("url_known", pages)
    marked = pages.withColumn(at, found)
    share = lambda verdict: F.avg(F.coalesce((F.col(f"{at}.fit.verdict") == verdict).cast("double"), F.lit(0.0)))
    seeds = cut_lineage(
        marked.filter(f"`{at}`.host <> ''").groupBy(F.col(f"{at}.host").alias("host"))
        .agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    )
    known = spread(host_links(pages, host, html_col), seeds, tolerance, damping).select(F.struct("host", "trust", "distrust").alias(known_at))
    joined = marked.join(known, F.col(f"{at}.host") == F.col(f"{known_at}.host"), "left")
    trust, distrust = (F.coalesce(F.col(f"{known_at}.{c}"), F.lit(0.0)) for c in ("trust", "distrust"))
    spoken = F.when(distrust > trust + threshold, "block").otherwise("allow")
    return joined.select(
        *[F.col(f"`{c}`") for c in pages.columns if c != "url_verdict"],
        F.struct(
            F.col(f"{at}.host").alias("host"), F.col(f"{at}.path").alias("path"), F.col(f"{at}.fit.rule").alias("rule"),
            F.coalesce(f"{at}.fit.verdict", spoken).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"),
        ).alias("url_verdict"),
    )
