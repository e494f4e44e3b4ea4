"""URL rules by hashed expressions, with DataFrame functions only.

A url is expanded into pairs of a host suffix and a path prefix. Expressions
meet the rules on a short hash prefix; the full digest confirms, and the
longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hex digits of the digest that the join uses.
SHORT = 8


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z as a-z) and path; both empty for null and for a url without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return _lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def expressions(host: Column, path: Column, labels: Column, lengths: Column) -> Column:
    """All pairs of a suffix of ``host`` of some number of labels and a prefix of ``path`` of some length."""
    own = F.split(host, r"\.")
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(own)), lambda n: F.array_join(F.slice(own, F.size(own) - n + 1, n), "."))
    prefixes = F.transform(F.filter(lengths, lambda n: n <= F.length(path)), lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("host"), p.alias("path")))))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def verdicts(df: DataFrame, rules: DataFrame, id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """One row (page_id, host, path, rule, verdict) per row of ``df``.

    ``rules`` has host, path (literal prefix, usually from ``/`` on) and verdict. A rule fits its host and all
    subdomains, where the url's path starts with the rule's. Of the rules that fit, the one with the longest host wins,
    then the longest path; of equal rules, ``block`` goes before ``allow``. Rules with a null in any column are ignored; without
    a rule, rule is null and verdict ``default``. A url without ``://`` has neither host nor path and fits
    only a rule with both empty; a null url looks the same and fits none. Every distinct url is judged once, so repeated rows and hot urls cost one
    judgement; repeated ids are rows like any other. Other columns are not read; an empty table gives an empty one.
    """
    rules = rules.select(_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), "verdict").where(
        "rule_host IS NOT NULL AND rule_path IS NOT NULL AND verdict IS NOT NULL"
    )
    rules = rules.groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("rule_verdict"))
    full = _digest(F.col("rule_host"), F.col("rule_path"))
    rules = rules.withColumn("digest", full).withColumn("short", F.substring("digest", 1, SHORT))
    # only suffixes and prefixes of sizes that some rule has; as many as the longest rule has characters at most
    labels = rules.agg(F.collect_set(F.size(F.split("rule_host", r"\."))).alias("x")).scalar()
    lengths = rules.agg(F.collect_set(F.length("rule_path")).alias("x")).scalar()
    pages = df.select(F.col(f"`{id}`").alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"))
    host, path = parts(F.col("url"))
    urls = pages.select("url").where("url IS NOT NULL").distinct().select("url", host.alias("host"), path.alias("path"))
    tried = urls.select("url", "host", "path", labels.alias("labels"), lengths.alias("lengths"))
    tried = tried.select("url", F.explode(expressions(*map(F.col, ("host", "path", "labels", "lengths")))).alias("e"))
    tried = tried.select("url", _digest(F.col("e.host"), F.col("e.path")).alias("tried"))
    tried = tried.withColumn("tried_short", F.substring("tried", 1, SHORT))
    met = tried.join(rules, F.col("tried_short") == F.col("short")).where(F.col("tried") == F.col("digest"))
    won = met.groupBy("url").agg(
        F.max(F.struct(F.length("rule_host").alias("a"), F.length("rule_path").alias("b"), "rule_host", "rule_path", "rule_verdict")).alias("r")
    )
    judged = pages.join(won, "url", "left")
    return judged.select(
        "page_id", host.alias("host"), path.alias("path"),
        F.concat(F.col("r.rule_host"), F.col("r.rule_path")).alias("rule"), F.coalesce(F.col("r.rule_verdict"), F.lit(default)).alias("verdict"),
    )
