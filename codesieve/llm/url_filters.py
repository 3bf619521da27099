"""Verdicts for URLs by many pattern rules, each found by its rarest literal token; DataFrame functions only.

A rule has a host, a path prefix and a verdict.  Its literal tokens (whole runs of letters and digits that every
matching URL must contain) are counted over all URLs, and the rule is filed under its rarest one.  The tokens of a
URL fetch the rules filed under them; only these run their regular expression.  Rules without a literal token are
filed under the empty token, which every URL has.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from codesieve.operators.partitioning import join_hot

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = "[^A-Za-z0-9]+"


@dataclass(frozen=True)
class UrlRule:
    """``host``: also fits all subdomains.  ``path``: what the URL's path starts with; ``*`` is any run in it."""

    host: str
    path: str
    verdict: str


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    raw = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _pattern(rule: UrlRule) -> str:
    """Expression for host and path written together."""
    path = ".*".join(_quoted(part) for part in rule.path.split("*"))
    return f"(?s)^(?:[^/]*\\.)?{_quoted(rule.host.lower())}{path}"


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9 ])", r"\\\1", text)


def _literals(rule: UrlRule) -> list[str]:
    """Tokens that every URL of the rule holds whole: not those that touch a ``*`` or the open end of the path."""
    text = rule.host.lower() + rule.path
    runs = [(m.group(), m.end()) for m in re.finditer("[A-Za-z0-9]+", text) if not (
        text[m.start() - 1:m.start()] == "*" or text[m.end():m.end() + 1] == "*" or m.end() == len(text))]
    return sorted({run for run, _ in runs})


def rule_table(spark, rules: list[UrlRule]) -> DataFrame:
    """Rules as a table: rule, verdict, pattern, length, literals."""
    rows = [F.struct(
        F.lit(rule.host.lower() + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"),
        F.lit(_pattern(rule)).alias("pattern"), F.lit(len(rule.host + rule.path)).alias("length"),
        F.array(*map(F.lit, _literals(rule))).cast("array<string>").alias("literals")) for rule in rules]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("_rule")).select("_rule.*")


def url_tokens(urls: DataFrame) -> DataFrame:
    """``_host``, ``_path``, ``_token`` (each token once, and the empty one)."""
    tokens = F.array_distinct(F.concat(F.split(F.concat("_host", "_path"), TOKEN), F.array(F.lit(""))))
    return urls.select("_host", "_path", F.explode(tokens).alias("_token"))


def index_rules(tokens: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules with ``_token``: the literal that the fewest URLs hold (ties: the smaller text), or the empty one."""
    literals = rules.select("rule", F.explode_outer("literals").alias("_token")).fillna("", ["_token"])
    wanted = literals.select("_token").distinct()
    counts = tokens.join(wanted, "_token", "left_semi").groupBy("_token").agg(F.count(F.lit(1)).alias("_urls"))
    ranked = literals.join(counts, "_token", "left").withColumn("_rank", F.row_number().over(
        W.partitionBy("rule").orderBy(F.coalesce("_urls", F.lit(0)), "_token")))
    return rules.join(ranked.where("_rank = 1").select("rule", "_token"), "rule").drop("literals")


def judge(df: DataFrame, rules: list[UrlRule], url_column: str = "url", id_column: str = "page_id",
          default: str = "allow") -> DataFrame:
    """One row per row of ``df``: the id, host, path, rule (the longest that fits; else null), verdict.

    Rules must differ in host and path.  A URL that no rule fits gets ``default``; so does a null one and one
    without ``://``, whose host and path are empty.  Equal URLs are judged once.  Ids may be null or repeated; other columns are
    not read; an empty table gives an empty result.  Ties in length are won by the smaller rule text.
    """
    if len({(rule.host.lower(), rule.path) for rule in rules}) < len(rules):
        raise ValueError("two rules with one host and path")
    url = F.col(url_column)
    pages = df.select(F.col(id_column).alias("_id"), host_of(url).alias("_host"), path_of(url).alias("_path"))
    urls = pages.select("_host", "_path").where("_host <> '' or _path <> ''").distinct()
    tokens = url_tokens(urls)
    index = index_rules(tokens, rule_table(df.sparkSession, rules))
    fits = tokens.join(index, "_token").where(F.rlike(F.concat("_host", "_path"), F.col("pattern")))
    best = fits.groupBy("_host", "_path").agg(F.min(F.struct(
        -F.col("length"), "rule", "verdict")).alias("_best"))
    # One URL may hold much of the table.
    joined = join_hot(pages, best, ["_host", "_path"], "left", spread_by=F.xxhash64("_id"))
    return joined.select(
        F.col("_id").alias(id_column), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"))
