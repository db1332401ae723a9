"""URL filtering by pattern rules that are indexed by their rarest literal token.

A rule is a regular expression with the literal tokens that every match contains. The index
files each rule under the one of its tokens that the fewest URLs hold. A URL's own tokens
fetch candidate rules by an equi-join, and only those run their expression. A rule without
a literal token is filed under the empty token, which every URL has.

Rules that name a host and a path become expressions over ``.host/path``; they go before
plain patterns, and of several the longest wins (then block before allow, then by name). A
URL that no rule fits gets ``allow``.

Defined results: null URLs and URLs without ``://`` have an empty host and path and are
matched as such; equal URLs are judged once and get equal answers, repeated rows are all
kept; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmine.llm.common import local_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class Rule:
    """``pattern`` is searched in ``.host`` + path (``on='page'``) or in the whole URL (``on='url'``)."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    on: str = "url"


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """A rule for a host with its subdomains and all paths that start with ``path``."""
    return Rule(
        host + path, verdict, rf"^[^/]*\.{re.escape(host)}{re.escape(path)}",
        tuple(t for t in re.split(r"[^a-z0-9]+", host) if t) + tuple(t.lower() for t in re.findall(r"(?<=/)[A-Za-z0-9]+(?=/)", path)), "page",
    )


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + F.lit(3))).otherwise("")
    return F.translate(F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + F.lit(3))).otherwise("")
    return F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct runs of lower-case ASCII letters and digits, and the empty token."""
    return F.array_union(F.array(F.lit("")), F.array_distinct(F.split(F.translate(F.coalesce(url, F.lit("")), UPPER, LOWER), "[^a-z0-9]+")))


def judged_urls(urls: DataFrame, url_col: str, rules: list[Rule]) -> DataFrame:
    """(url, rule, pattern, verdict) of every distinct URL that a rule fits."""
    spark = urls.sparkSession
    filed_under = [(r.name, r.verdict, r.pattern, r.on, t) for r in rules for t in (r.tokens or ("",))]
    names = ("name", "verdict", "pattern", "on", "token")
    table = local_table(spark, {n: pa.array([x[i] for x in filed_under], pa.string()) for i, n in enumerate(names)})
    small = F.broadcast if len(rules) <= MAX_BROADCAST_RULES else (lambda x: x)
    seen = urls.select(F.col(url_col).alias("url")).distinct().withColumn("token", F.explode(tokens_of(F.col("url"))))
    # how many URLs hold each token that some rule needs
    held = seen.join(small(table.select("token").distinct()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = (
        table.join(held, "token", "left")
        .groupBy("name", "verdict", "pattern", "on")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("token"))).alias("token"))
    )
    near = seen.join(small(filed), "token")
    page = F.concat(F.lit("."), host_of(F.col("url")), path_of(F.col("url")))
    fits = near.filter(F.regexp_like(F.when(F.col("on") == "page", page).otherwise(F.coalesce("url", F.lit(""))), F.col("pattern")))
    order = F.struct((F.col("on") == "page"), F.when(F.col("on") == "page", F.length("name")).otherwise(0), F.col("verdict"), F.col("name"))
    return fits.groupBy("url").agg(F.max_by(F.struct("name", "on", "verdict"), order).alias("best")).select(
        "url", F.when(F.col("best.on") == "page", F.col("best.name")).alias("rule"),
        F.when(F.col("best.on") == "url", F.col("best.name")).alias("pattern"), F.col("best.verdict").alias("verdict"),
    )


def filter_urls(pages: DataFrame, url_col: str, rules: list[Rule], keep: list[str]) -> DataFrame:
    """Every row of ``pages`` (the ``keep`` columns) with host, path, rule, pattern and verdict."""
    own = pages.select(*keep, F.col(url_col).alias("_url"))
    best = judged_urls(own, "_url", rules).withColumnRenamed("url", "_fit")
    return own.join(best, F.col("_url").eqNullSafe(F.col("_fit")), "left").select(
        *keep, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"), "pattern",
    )
