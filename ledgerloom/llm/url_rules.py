"""URL rules by hashed expressions; DataFrame functions only.

Each URL is expanded into its host suffixes (whole labels) joined with its path prefixes (of the lengths
that rules have). Expressions meet rules in an equi-join on a short prefix of their digests; the full
digest then confirms the match, and the longest rule that fits decides.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hex digits of a digest that the equi-join compares.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without a ://."""
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def url_path(url: Column) -> Column:
    """From the host's end up to ?, # or the end; empty without a ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a table."""
    names = ("verdict", "host", "path")
    rows = [
        F.struct(*[F.lit(value).cast("string").alias(name) for name, value in zip(names, rule, strict=True)])
        for rule in rules
    ]
    kind = "array<struct<verdict: string, host: string, path: string>>"
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*rows).cast(kind)))


def _expression(host: Column, path: Column) -> Column:
    # Hosts hold no slash and a path is empty or begins with one; the separator keeps them apart anyway.
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _numbers(values: list[int]) -> Column:
    return F.array(*[F.lit(n) for n in values]).cast("array<int>")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    *,
    url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Add host, path, rule and verdict to every row.

    A rule (verdict, host, path) fits its host and all subdomains, if the path of the URL starts with the
    rule's. The rule with the longest host and path together wins, then the one with the longer host, then
    block over allow. `rule` is the winner's host and path, null where none fits; the verdict is then
    `default`. A null URL, or one without ://, has an empty host and path. Repeated rows are judged
    alike; very long URLs are expanded only at the lengths that rules have; an empty table gives no rows;
    columns of the added names are replaced.
    """
    rules = rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
    # Metadata of the rules: the distinct lengths of their paths and label counts of their hosts.
    shape = rules.agg(
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
    ).first()
    table = rules.select(
        F.struct(
            (F.length("host") + F.length("path")).alias("length"),
            F.length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("found"),
        _expression(F.col("host"), F.col("path")).alias("rule_digest"),
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))

    added = ("host", "path", "rule", "verdict")
    names = [name for name in pages.columns if name.lower() not in added]
    row = F.struct(*[F.col(f"`{name}`") for name in names]).alias("row")
    link = F.col(f"`{url}`").cast("string")
    parsed = pages.select(row, url_host(link).alias("host"), url_path(link).alias("path"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.filter(_numbers(shape["labels"]), lambda n: n <= F.size(labels)),
        lambda n: F.array_join(F.slice(labels, F.size(labels) - n + 1, n), "."),
    )
    prefixes = F.transform(
        F.filter(_numbers(shape["lengths"]), lambda n: n <= F.length("path")),
        lambda n: F.substr(F.col("path"), F.lit(1), n),
    )
    digests = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: _expression(s, p)))
    )
    best = parsed.select("host", "path").distinct().select("host", "path", F.explode(digests).alias("digest"))
    best = (
        best.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        .join(table, "short")
        .filter(F.col("digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max("found").alias("found"))
    )
    joined = parsed.join(best, ["host", "path"], "left")
    return joined.select(
        *[F.col(f"row.`{name}`").alias(name) for name in names],
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.lit(default)).alias("verdict"),
    )
