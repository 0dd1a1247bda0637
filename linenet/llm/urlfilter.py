"""URL rules, and block decisions carried to aliases. Spark expressions and joins only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linenet.llm.components import connected_components
from linenet.llm.scratch import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*?\bcontent\s*=\s*[\"']?[0-9.\s]*;\s*url\s*=\s*[\"']?([^\"'\s>]+)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """What stands for an address among aliases: host, path and query; none for no address."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), F.when(path_of(url) == "", "/").otherwise(path_of(url)), query))


def _target(url: Column, html: Column, pattern: str) -> Column:
    """The address a page names with a pattern, made absolute; none if there is none."""
    link = F.regexp_replace(F.regexp_extract(html, pattern, 1), "&amp;", "&")
    start = F.regexp_extract(url, r"(?s)^(.*?:)//", 1)
    folder = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    full = (
        F.when(link.contains("://"), link)
        .when(link.startswith("//"), F.concat(start, link))
        .when(link.startswith("/"), F.concat(start, F.lit("//"), host_of(url), link))
        .otherwise(F.concat(folder, link))
    )
    return F.when((link != "") & ~link.startswith("#"), full)


def _allowed_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host`` and ``rules``, those that hold for it or a domain above it, of the hosts that have any."""
    labels = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    keys = hosts.select("host").where("host <> ''").distinct().withColumn("rule_host", F.explode(above))
    told = rules.groupBy("rule_host", "rule_path").agg(F.min("verdict").alias("verdict"))  # of equal rules, allow holds
    return keys.join(told, "rule_host").groupBy("host").agg(F.collect_list(F.struct("rule_host", "rule_path", "verdict")).alias("rules"))


def judge(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """Add ``rule`` (host and path of the longest that fits) and ``rule_verdict`` to rows with ``host`` and ``path``.

    Rules meet distinct hosts and all domains above them by equality; a rule's host is a key once, however
    many addresses have it.
    """
    told = addresses.join(_allowed_rules(addresses, rules), "host", "left")
    fits = F.filter(F.coalesce("rules", F.array().cast("array<struct<rule_host:string,rule_path:string,verdict:string>>")), lambda r: F.col("path").startswith(r["rule_path"]))
    named = F.transform(fits, lambda r: F.struct(F.length(F.concat(r["rule_host"], r["rule_path"])).alias("n"), F.concat(r["rule_host"], r["rule_path"]).alias("rule"), r["verdict"].alias("verdict")))
    best = F.array_max(named)
    return told.withColumn("rule", best["rule"]).withColumn("rule_verdict", best["verdict"]).drop("rules")


def filter_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page.

    ``rules`` has ``rule_host``, ``rule_path`` and ``verdict`` (allow or block). A page with a rule has its
    verdict. Pages and the addresses they redirect to (refresh) or name as canonical are aliases, across any
    number of steps; a page without a rule is allowed if one of its aliases is allowed by a rule, else
    blocked if one is blocked by a rule, else allowed. Addresses that differ in scheme or fragment alone are one.

    A null address or one without ``://`` has empty host and path, no rule and no aliases, and is allowed. A null
    ``html`` names no alias. Repeated rows are judged each; no pages give no rows; further columns are
    not returned.
    """
    url = F.col("url")
    kept = pages.select(
        "page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"),
        node_of(_target(url, F.col("html"), CANONICAL)).alias("canonical"), node_of(_target(url, F.col("html"), REFRESH)).alias("redirect"),
    )
    kept = written(kept, "addresses")
    edges = kept.select("node", F.explode(F.array("canonical", "redirect")).alias("alias"))
    linked = connected_components(edges, "node", "alias")
    parts = linked.withColumn("host", F.regexp_extract("node", r"(?s)^([^/?]*)", 1)).withColumn("path", F.regexp_extract("node", r"(?s)^[^/?]*([^?]*)", 1))
    ruled = judge(parts, rules).groupBy("component").agg(F.min("rule_verdict").alias("carried"))  # allow comes before block
    carried = linked.join(ruled.where("carried is not null"), "component").select("node", "carried")
    told = judge(kept.select("page_id", "host", "path", "node"), rules).join(carried, "node", "left")
    return told.select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", "carried", F.lit("allow")).alias("verdict"))
