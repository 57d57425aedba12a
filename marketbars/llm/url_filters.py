"""URL filters: rules on host suffixes and path prefixes, by hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketbars.llm.shared import lower_ascii

# The first `://`, then the host, then the path.
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, _PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _hashed(expression: str) -> list[Column]:
    digest = F.sha2(F.col(expression).cast("binary"), 256)
    return [digest.alias("digest"), F.substring(digest, 1, _PREFIX_DIGITS).alias("short")]


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    key: str = "page_id",
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """The longest rule that fits each URL, and its verdict.

    `rules` has `host`, `path` and `verdict`. A rule fits its host and all
    subdomains of it where the URL's path starts with the rule's. Each distinct
    URL is expanded into host suffixes times path prefixes, as many labels and
    as long as the rules have them; these meet the rules in an equi-join on the
    first 32 bits of their SHA-256, after which the full digest decides.

    Result: the key, `host`, `path`, `rule` (null if none fits), `verdict`
    (`default` if none fits), one row for each row of `pages`. A URL that is
    null or has no `://` has an empty host and path and gets the default. Of
    equal rules, and of fitting rules of equal length, `block` wins, then the
    longer host. Rules without a host or path are ignored; without rules, and
    for an empty table, the result still has all rows. Other columns of either
    table are not looked at.

    Only the rules' own shape goes to the driver: one row with the most labels
    of a host and the distinct lengths of paths.
    """
    rules = (
        rules.select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("rule", F.concat("host", "path"))
    )
    shape = rules.agg(
        F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0)).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()
    lengths = F.array(*[F.lit(n) for n in sorted(shape.lengths)]).cast("array<int>")
    rules = rules.select("rule", "verdict", F.length("host").alias("host_length"), *_hashed("rule"))

    keyed = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    parts = F.split("host", r"\.")
    count = F.least(F.size("parts"), F.lit(shape.labels))
    suffixes = F.transform(
        F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")),
        lambda n: F.array_join(F.slice("parts", F.size("parts") - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")),
        lambda n: F.col("path").substr(F.lit(1), n),
    )
    expressions = (
        keyed.where(F.col("url").isNotNull())
        .select("url")
        .distinct()
        .select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
        .withColumn("parts", parts)
        .select("url", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("url", "suffix", F.explode("prefixes").alias("prefix"))
        .select("url", F.concat("suffix", "prefix").alias("expression"))
        .select("url", *_hashed("expression"))
    )
    fits = (
        expressions.alias("e")
        .join(rules.alias("r"), F.col("e.short") == F.col("r.short"))
        .where(F.col("e.digest") == F.col("r.digest"))
        .groupBy("e.url")
        .agg(
            F.max(
                F.struct(
                    F.length("r.rule").alias("length"),
                    (F.col("r.verdict") == "block").alias("block"),
                    F.col("r.host_length").alias("host_length"),
                    F.col("r.rule").alias("rule"),
                    F.col("r.verdict").alias("verdict"),
                )
            ).alias("best")
        )
        .select(F.col("url").alias("fit_url"), "best")
    )
    return keyed.join(fits, F.col("url") == F.col("fit_url"), "left").select(
        F.col("key").alias(key),
        url_host(F.col("url")).alias("host"),
        url_path(F.col("url")).alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
