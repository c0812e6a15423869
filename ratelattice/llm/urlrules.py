"""Allow and block rules for URLs.

A rule has a host and a path; it fits a URL whose host is the rule's host or a subdomain of it
and whose path starts with the rule's path.  The rule with the longest host and path wins, then
block before allow.  A URL is expanded into expressions, every suffix of its host at a dot
with every prefix of its path that is as long as some rule's path; expressions and rules meet
by the first 32 bits of the SHA-256 of "host path", and the full digests confirm the match.

Only distinct (host, path) pairs are expanded, so a URL that occurs a million times is judged
once.  A null URL, or one without "://", has an empty host and path and fits no rule unless a
rule is empty too.  Rules with a null host or path never fit; repeated rules count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelattice.sources.kept import keep

HASH_PREFIX = 8  # hex digits, 32 bits
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z lowered; empty without "://"."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat_ws(" ", host, path), 256)


def expressions(keys: DataFrame, lengths: list[int]) -> DataFrame:
    """Rows (host, path, digest): the expressions of each (host, path)."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))
    wide = keys.withColumn("__suffix", F.explode(suffixes))
    wide = wide.withColumn("__length", F.explode(F.array(*[F.lit(n) for n in lengths]))).filter("__length <= length(path)")
    prefix = F.expr("substring(path, 1, __length)")
    return wide.select("host", "path", _digest(F.col("__suffix"), prefix).alias("digest"))


def judge_urls(pages: DataFrame, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict.

    ``rules`` has host, path, verdict; ``otherwise`` is the verdict where no rule fits.
    """
    known = rules.filter("host is not null and path is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    known = keep(known.withColumn("digest", _digest(F.col("host"), F.col("path"))), "rules")
    # at most as many values as the longest path has characters
    lengths = sorted(known.agg(F.collect_set(F.length("path")).alias("n")).first()["n"])
    rows = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    if not lengths:
        return rows.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(otherwise)})
    rows = keep(rows, "urls")
    short = known.select(
        F.left("digest", F.lit(HASH_PREFIX)).alias("short"),
        F.col("digest").alias("full"),
        F.concat("host", "path").alias("rule"),
        "verdict",
    )
    tried = expressions(rows.select("host", "path").distinct(), lengths).withColumn("short", F.left("digest", F.lit(HASH_PREFIX)))
    fits = tried.join(short, "short").filter("digest = full")
    order = F.struct(F.length("rule"), F.col("verdict"), F.col("rule"))  # block sorts after allow
    best = fits.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    best = keep(best.select(F.col("host").alias("h"), F.col("path").alias("p"), "best.*"), "best")
    judged = rows.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
