"""URL filter: host-suffix and path-prefix expressions, hash-prefix equi-join, full-digest check.

Native: DataFrame functions only. Null or scheme-less urls have an empty host and path, match no
rule and get the default verdict. Repeated urls are judged once and every page row is returned. An
empty rule list gives every page the default. Other columns of the pages are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed by the contract: (host, path, verdict).
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
RULE_SCHEMA = "rule_host string, rule_path string, verdict string"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first ``://``: up to ``/ ? #``, A-Z lower-cased; then up to ``? #``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def rule_digests(rules: DataFrame, prefix_hex: int) -> DataFrame:
    """Rules keyed by the SHA-256 of ``host + path``; of equal rules the blocking one stands."""
    name = F.concat("rule_host", "rule_path")
    return (
        rules.groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
        .select(
            name.alias("rule"),
            "verdict",
            (F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."), F.lit(""))) + 1).alias("labels"),
            F.length("rule_path").alias("path_length"),
            F.sha2(name, 256).alias("digest"),
        )
        .withColumn("prefix", F.substring("digest", 1, prefix_hex))
    )


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", prefix_hex: int = 8) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    A url is expanded only to the shapes (host labels, path length) that some rule has, so a very
    long url makes no more expressions than a short one. Shapes are distinct pairs over the rules.
    """
    known = rule_digests(rules, prefix_hex)
    shapes = known.select("labels", "path_length").distinct().agg(F.collect_list(F.struct("labels", "path_length")).alias("shapes"))
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").where(F.col("url").contains("://")).distinct().select("url", host.alias("host"), path.alias("path"))
    labels = F.size(F.split("host", r"\."))
    expressions = (
        urls.withColumn("shapes", shapes.scalar())
        .select("url", labels.alias("n"), F.length("path").alias("m"), "host", "path", F.explode("shapes").alias("shape"))
        .where((F.col("n") >= F.col("shape.labels")) & (F.col("m") >= F.col("shape.path_length")))
        .select(
            "url",
            F.sha2(
                F.concat(
                    F.expr("substring_index(host, '.', -shape.labels)"),
                    F.expr("substring(path, 1, shape.path_length)"),
                ),
                256,
            ).alias("full"),
        )
        .withColumn("prefix", F.substring("full", 1, prefix_hex))
    )
    best = (
        expressions.join(known, "prefix")
        .where(F.col("full") == F.col("digest"))
        .groupBy("url")
        .agg(F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "verdict", "rule")).alias("best"))
    )
    return (
        pages.select("page_id", "url")
        .join(best, "url", "left")
        .select(
            "page_id",
            host.alias("host"),
            path.alias("path"),
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )


def fixed_rules(spark, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)
