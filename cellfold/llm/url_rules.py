"""URL rules by hashed expressions (operator 10).

A rule is a host and a path prefix. It fits a URL whose host is the rule's or
a subdomain of it and whose path starts with the rule's path. Every URL is
expanded into expressions, one for each suffix of its host labels and each
prefix of its path, the expressions are hashed with SHA-256, and an equi-join
on the first four bytes finds candidate rules. The full digests are compared
after the join, so a clash of short prefixes cannot fit a wrong rule. Among
the rules that fit, the longest (host and path together) wins, then the one
with the longer host; between equal rules ``block`` wins over ``allow``.

Only distinct (host, path) pairs are expanded, so a URL that a third of all
pages share costs one expansion; the verdict returns by an equi-join that
adaptive execution can split. Prefix lengths and label counts that no rule
has are not expanded, which bounds the work on hostile URLs.

Defined cases: a null URL and one without ``://`` have an empty host and path
and fit no rule (rules need a host); an empty rule set gives every URL the
default verdict; duplicate URLs and other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellfold.llm.words import lower_ascii, unused_name

PREFIX_HEX = 8  # four bytes


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\x00"), path).cast("binary"), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``; existing
    columns of these names are replaced, the URL column stays.

    ``rules`` has ``host``, ``path``, ``verdict``; it may be large, the join is
    an ordinary equi-join whose side Spark broadcasts only below its size
    threshold. One small job reads the label counts and path lengths in use.
    """
    rules = (rules.select(lower_ascii("host").alias("host"), "path", "verdict")
             .filter("host != '' and path is not null").distinct())
    rules = rules.withColumn("digest", _digest(F.col("host"), F.col("path")))
    used = rules.agg(F.collect_set(F.size(F.split("host", r"\."))).alias("labels"),
                     F.collect_set(F.length("path")).alias("lengths")).first()
    numbers = lambda xs: f"cast(array({', '.join(map(str, sorted(xs)))}) as array<int>)"
    u = f"`{url}`"
    work_host, work_path, h, p, best_of = unused_name(pages, "_host", "_path", "h", "p", "best")
    kept = [c for c in pages.columns if c == url or c.lower() not in ("host", "path", "rule", "verdict")]
    split = pages.select(*[F.col(f"`{c}`") for c in kept],
                         host_of(F.col(u)).alias(work_host), path_of(F.col(u)).alias(work_path))
    places = split.filter(F.col(work_host) != "").select(
        F.col(work_host).alias("h"), F.col(work_path).alias("p")).distinct()
    parts = places.withColumn("l", F.split("h", r"\."))
    # host suffixes of n labels, path prefixes of n characters
    suffixes = F.expr(f"transform(filter({numbers(used['labels'])}, n -> n <= size(l)), "
                      "n -> substring_index(h, '.', -n))")
    prefixes = F.expr(f"transform(filter({numbers(used['lengths'])}, n -> n <= length(p)), "
                      "n -> substring(p, 1, n))")
    expanded = (parts.select("h", "p", F.explode(suffixes).alias("eh"), prefixes.alias("ps"))
                .select("h", "p", "eh", F.explode("ps").alias("ep"))
                .withColumn("d", _digest(F.col("eh"), F.col("ep")))
                .withColumn("short", F.substring("d", 1, PREFIX_HEX)))
    hits = (expanded.join(rules.withColumnsRenamed({"host": "rh", "path": "rp", "verdict": "rv"})
                          .withColumn("short", F.substring("digest", 1, PREFIX_HEX)), "short")
            .filter(F.col("d") == F.col("digest")))
    best = hits.groupBy("h", "p").agg(F.max(F.struct(
        (F.length("rh") + F.length("rp")).alias("a"), F.length("rh").alias("b"), (F.col("rv") == "block").alias("c"),
        F.concat("rh", "rp").alias("rule"), F.col("rv").alias("verdict"))).alias("best"))
    best = best.toDF(h, p, best_of)
    return (split.join(best, (F.col(work_host) == F.col(h)) & (F.col(work_path) == F.col(p)), "left")
            .select(*[F.col(f"`{c}`") for c in kept],
                    F.col(work_host).alias("host"), F.col(work_path).alias("path"),
                    F.col(best_of)["rule"].alias("rule"),
                    F.coalesce(F.col(best_of)["verdict"], F.lit(default)).alias("verdict")))
