"""URL filter: host-suffix and path-prefix expressions, matched by short hash, then by digest.

A rule has a host, a path and a verdict.  It fits its host and all subdomains,
for every path that starts with the rule's path.  Of the rules that fit a URL,
the longest (host and path together) wins; among equally long ones the longer
host, then ``block``.

Rules and URLs meet in an equality join on the first hex digits of the SHA-256
of an expression, so the join key stays short for any rule; the whole digest
confirms a match.  A URL has at most as many expressions as the rules have
host lengths (in labels) times path lengths, however long the URL is.

Null URLs and URLs without ``://`` have an empty host and path and fit no rule.
Repeated rows are judged each.  Without rules everything gets the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtide.llm.common import ascii_lower

RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"
SHORT_HASH = 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(url)), "^[^?#]*", 0)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def _hashed_rules(rules: DataFrame) -> DataFrame:
    """One row per expression; equal rules with two verdicts block."""
    host = ascii_lower(F.col("rule_host"))
    return (
        rules.where(F.col("rule_host").isNotNull() & F.col("rule_path").isNotNull())
        .select(
            F.concat(host, F.col("rule_path")).alias("rule"),
            F.length(host).alias("host_length"),
            F.col("rule_verdict"),
        )
        .groupBy("rule", "host_length")
        .agg(F.max_by("rule_verdict", F.col("rule_verdict") == "block").alias("rule_verdict"))
        .withColumn("rule_digest", _digest(F.col("rule")))
        .withColumn("short_hash", F.substring("rule_digest", 1, SHORT_HASH))
    )


def _shapes(rules: DataFrame) -> tuple[list[int], list[int]]:
    """Distinct label counts of hosts and lengths of paths: small numbers, few of them."""
    row = rules.agg(
        F.array_sort(F.collect_set(F.size(F.split("rule_host", "\\.")))).alias("labels"),
        F.array_sort(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()
    return list(row.labels), list(row.lengths)


def _expressions(labels: list[int], lengths: list[int]) -> Column:
    """All distinct expressions of a host and path that a rule of these shapes can equal."""
    host, path = F.col("host"), F.col("path")
    made = [
        F.when(
            F.length(path) >= length,
            F.concat(F.substring_index(host, ".", -label), F.substring(path, 1, length)),
        )
        for label in labels
        for length in lengths
    ]
    return F.array_distinct(F.array_compact(F.array(*made)))


def filter_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow"
) -> DataFrame:
    """The pages with host, path, the winning rule (or null) and the verdict.

    Columns of these names in the input are replaced.
    """
    host, path = host_and_path(F.col(url))
    judged = pages.drop("rule", "verdict").withColumns({"host": host, "path": path})
    labels, lengths = _shapes(rules)
    if not labels:
        return judged.withColumns(
            {"rule": F.lit(None).cast("string"), "verdict": F.lit(default)}
        )
    # Each host and path is expanded once, however many pages share it.
    places = judged.where("host <> ''").select("host", "path").distinct()
    expanded = (
        places.select("host", "path", F.explode(_expressions(labels, lengths)).alias("expression"))
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("short_hash", F.substring("digest", 1, SHORT_HASH))
    )
    fits = expanded.join(_hashed_rules(rules), "short_hash").where("digest = rule_digest")
    rank = F.struct(F.length("rule"), "host_length", F.col("rule_verdict") == "block")
    winners = fits.groupBy("host", "path").agg(
        F.max_by(F.struct("rule", "rule_verdict"), rank).alias("winner")
    )
    return (
        judged.join(winners, ["host", "path"], "left")
        .withColumns(
            {
                "rule": F.col("winner.rule"),
                "verdict": F.coalesce(F.col("winner.rule_verdict"), F.lit(default)),
            }
        )
        .drop("winner")
    )
