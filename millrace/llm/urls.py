"""URL rules: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower, kept_apart, materialize, restored

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _folder(path: Column) -> Column:
    """The path up to its last slash: the longest expression that every fitting URL has."""
    return F.regexp_extract(path, r"(?s)^(.*/)", 1)


def _expressions(urls: DataFrame) -> DataFrame:
    """One row for each host suffix and each path prefix that ends in a slash (or is empty)."""
    labels = F.explode(F.sequence(F.lit(1), F.length(F.regexp_replace("host", r"[^.]", "")) + 1))
    slashes = F.explode(F.sequence(F.lit(0), F.length(F.regexp_replace("path", r"[^/]", ""))))
    cut = urls.withColumn("labels", labels).withColumn("slashes", slashes)
    return cut.select(
        "url", "path",
        F.expr("substring_index(host, '.', -labels)").alias("suffix"),
        F.expr("if(slashes = 0, '', concat(substring_index(path, '/', slashes), '/'))").alias("prefix"),
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    ``rules``: ``host``, ``path``, ``verdict`` (allow or block). A rule fits its
    host and all subdomains when the path starts with the rule's path. The
    longest rule (host and path together) wins; of equally long ones that with
    the longer host, then block, then the greater text. Without a fitting rule
    ``rule`` is null and the verdict is ``default``.

    Each distinct URL becomes its host-suffix and path-prefix expressions. They
    meet the rules in an equi-join on the first 32 bits of a SHA-256 digest;
    the full digest, host and path then confirm the hit. Rules are broadcast
    only if Spark finds their written table below its threshold.

    Null URLs and those without ``://`` have an empty host and path and fit no
    rule with a host. Repeated rows stay, each with the same verdict; empty tables give
    empty results; columns of the input named like an added one are replaced.
    """
    rule_key = F.sha2(F.concat("host", _folder(F.col("path"))), 256)
    known = materialize(
        rules.where("host is not null and path is not null").select(
            F.substring(rule_key, 1, PREFIX_DIGITS).alias("short"), rule_key.alias("digest"),
            F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict",
        ).distinct(),
        "url-rules",
    )
    packed = kept_apart(pages, url=url)
    parsed = packed.select("url").where("url is not null").distinct().select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    key = F.sha2(F.concat("suffix", "prefix"), 256)
    asked = _expressions(parsed).select("url", "path", "suffix", key.alias("asked")).withColumn("short", F.substring("asked", 1, PREFIX_DIGITS))
    confirmed = (F.col("asked") == F.col("digest")) & (F.col("suffix") == F.col("rule_host")) & F.col("path").startswith(F.col("rule_path"))
    rank = F.struct(
        F.length("rule_host") + F.length("rule_path"), F.length("rule_host"), F.col("verdict") == "block",
        F.concat("rule_host", "rule_path").alias("rule"), F.col("verdict").alias("verdict"),
    )
    best = asked.join(known, "short").where(confirmed).groupBy("url").agg(F.max(rank).alias("best"))
    judged = materialize(best.select(F.col("url").alias("judged_url"), "best.rule", "best.verdict"), "judged-urls")
    joined = packed.join(judged, F.col("url") == F.col("judged_url"), "left").select(
        "row", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
    return restored(joined, pages.columns, "host", "path", "rule", "verdict")
