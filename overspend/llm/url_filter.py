"""URL filters: allow and block rules looked up by hashed expressions.

Every distinct URL is expanded into host-suffix x path-prefix expressions,
only for the label counts and path lengths that occur among the rules. The
expressions meet the rules in an equi-join on a short prefix of their SHA-256,
the full digests confirm the match, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower

PREFIX_HEX = 8  # 4 bytes of the digest in the equi-join


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # a NUL cannot be confused with a character of the other part
    return F.sha2(F.concat_ws("\0", host, path), 256)


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as (host, path, verdict) rows; verdict is ``allow`` or ``block``."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def filter_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """Judge every row: (id, host, path, rule, verdict).

    A rule fits its host and all subdomains, if the path starts with the
    rule's path. The longest rule (host and path together) wins, then the
    longer host, then ``block``. Without a rule: null and ``default``.

    Rules with a null or empty host, a null path or another verdict are
    ignored; a repeated rule counts once. A null url, or one without ``://``,
    has an empty host and path and gets the default. Repeated rows and null
    ids are each judged; other columns of ``pages`` are not read. Empty tables
    give empty results or the default.
    """
    r = (
        rules.where("host <> '' AND path IS NOT NULL AND verdict IN ('allow', 'block')")
        .select(ascii_lower(F.col("host")).alias("r_host"), F.col("path").alias("r_path"), (F.col("verdict") == "block").alias("r_block"))
        .groupBy("r_host", "r_path")
        .agg(F.max("r_block").alias("r_block"))
        .withColumn("digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("digest", 1, PREFIX_HEX))
    )
    # Two small sets of numbers, bounded by the longest host and path of a rule.
    labels = [x[0] for x in r.select(F.size(F.split("r_host", r"\."))).distinct().collect()]
    lengths = [x[0] for x in r.select(F.length("r_path")).distinct().collect()]

    seen = pages.select(
        F.col(id_col).alias("id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")
    ).fillna("", ["host", "path"])
    has = F.size(F.split("host", r"\."))
    suffixes = F.array(*[F.when(has >= k, F.substring_index("host", ".", -k)) for k in sorted(labels)])
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)])
    expressions = (
        seen.select("host", "path")
        .distinct()  # a hot URL is judged once
        .withColumn("suffix", F.explode(F.array_compact(suffixes.cast("array<string>"))))
        .withColumn("prefix", F.explode(F.array_compact(prefixes.cast("array<string>"))))
        .withColumn("full", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", F.substring("full", 1, PREFIX_HEX))
    )
    best = (
        expressions.join(r, "short")
        .where(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length("r_host") + F.length("r_path")).alias("n"),
                    F.length("r_host").alias("h"),
                    "r_block",
                    F.concat("r_host", "r_path").alias("rule"),
                )
            ).alias("best")
        )
    )
    return seen.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.when(F.col("best.r_block"), "block").when(~F.col("best.r_block"), "allow").otherwise(default).alias("verdict"),
    )
