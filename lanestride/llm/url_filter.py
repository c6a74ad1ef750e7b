"""URL rules by hash-prefix lookup of host-suffix and path-prefix expressions, in DataFrame functions only."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (verdict, host, path) of the standing rules.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
PREFIX_HEX = 8  # hex digits of a digest that the first join compares: 32 bits
DEFAULT_VERDICT = "allow"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """(verdict, host, path) rows; any DataFrame with these columns serves as rules."""
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path from there up to ``? #`` or the end.

    Null urls and urls without ``://`` have both empty.
    """
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and each suffix that starts after a dot."""
    labels = F.split(host, "\\.", -1)
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def path_prefixes(path: Column) -> Column:
    """The empty prefix and each prefix that ends in a slash."""
    steps = F.split(path, "/", -1)
    return F.transform(F.sequence(F.lit(0), F.size(steps) - 1),
                       lambda i: F.when(i == 0, F.lit("")).otherwise(F.concat(F.array_join(F.slice(steps, 1, i), "/"), F.lit("/"))))


def expression(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT_VERDICT,
          prefix_hex: int = PREFIX_HEX) -> DataFrame:
    """Every page with its host, path, the longest rule that fits and its verdict: key, host, path, rule, verdict.

    A rule (host, path) fits the host itself and its subdomains when the url's
    path starts with the rule's.  Distinct (host, path) pairs are expanded into
    host suffixes x path prefixes ending in a slash.  Rule and url expressions
    meet on a short prefix of their SHA-256, full digests then confirm; a rule
    path that goes on past its last slash is compared as text at the end.
    The longest rule wins; of equally long ones the greater host, then path,
    then ``block``.  A null or blank host, or no fitting rule, gets the default verdict
    and a null rule.  Rules with nulls are ignored, repeated ones count once.
    """
    host, path = url_parts(F.col(url))
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    wanted = (rules.select("verdict", F.col("host").alias("r_host"), F.col("path").alias("r_path")).dropna().distinct()
              .withColumn("r_head", F.regexp_extract("r_path", "^(.*/)?", 0))
              .withColumn("r_full", F.sha2(expression(F.col("r_host"), F.col("r_head")), 256))
              .withColumn("r_short", F.substring("r_full", 1, prefix_hex)))
    places = parts.where("host <> ''").select("host", "path").distinct()
    expanded = (places.select("host", "path", F.explode(host_suffixes(F.col("host"))).alias("suffix"))
                .select("host", "path", "suffix", F.explode(path_prefixes(F.col("path"))).alias("head"))
                .withColumn("full", F.sha2(expression(F.col("suffix"), F.col("head")), 256))
                .withColumn("short", F.substring("full", 1, prefix_hex)))
    met = (expanded.join(wanted, F.col("short") == F.col("r_short"))
           .where((F.col("full") == F.col("r_full")) & F.col("path").startswith(F.col("r_path"))))
    rank = F.struct((F.length("r_host") + F.length("r_path")).alias("size"), F.col("r_host"), F.col("r_path"), F.col("verdict"))
    best = (met.groupBy("host", "path").agg(F.max(rank).alias("best"))
            .select(F.col("host").alias("b_host"), F.col("path").alias("b_path"),
                    F.concat("best.r_host", "best.r_path").alias("rule"), F.col("best.verdict").alias("verdict")))
    return (parts.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
            .select(key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


def keep_allowed(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Pages whose verdict is not ``block``; the columns of the input."""
    blocked = judge(pages.select(key, url), rules, key, url).where("verdict = 'block'").select(key).distinct()
    return pages.join(blocked, key, "left_anti")


URL_SQL = """
WITH r(verdict, r_host, r_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
    ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT page_id, host, path, r_host || r_path AS rule, verdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(r_host) + length(r_path) DESC) AS n
    FROM p JOIN r ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path))
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM p LEFT JOIN f ON p.page_id = f.page_id AND f.n = 1
"""
