"""URL rules by host suffix and path prefix, found by hash prefix and confirmed in full.

A rule names a host and a beginning of the path; it fits that host and all subdomains.  Every
URL is written out as expressions: each suffix of its host at a dot, with each directory
of its path (the path up to one of its slashes, or no path).  A rule has one such
expression: its host with its path up to the last slash.  URL expressions meet rules in an
equi-join on the first 32 bits of SHA-256; then the full digest and the rest of
the rule's path are confirmed, and the longest rule wins.

No suffix with more labels, or directory with more slashes, than any rule has can meet
a rule, so those are not written out; that bounds the expressions of any URL by the rules.

Results for odd input: a URL that is null or has no ``://`` has an empty host and path and
fits no rule; a URL no rule fits gets the verdict DEFAULT and a null rule; of rules of equal
length, the one that sorts last wins; rows that repeat are judged each; rows without id are
kept; no rules at all is fine.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listinglake.llm.common import lower_ascii, table

DEFAULT = "allow"
# Rules up to this number (about 3 MB) go to every executor; more are joined by shuffle.
BROADCAST_RULES = 10_000


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; empty for a URL without ``://``."""
    # What follows the first ://; regular expressions with (?s) so that line ends count.
    rest = F.regexp_extract(url, r"(?s)\A.*?://(.*)\z", 1)
    host = F.coalesce(F.regexp_extract(rest, r"\A([^/?#]*)", 1), F.lit(""))
    path = F.coalesce(F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1), F.lit(""))
    return lower_ascii(host), path


def _rules(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    schema = "rule_host string, rule_path string, rule_verdict string"
    made = spark.createDataFrame([tuple(r) for r in rules], schema)
    expression = F.concat(
        lower_ascii(F.col("rule_host")), F.regexp_extract("rule_path", r"(?s)\A(.*/)?", 0)
    )
    digest = F.sha2(expression, 256)
    return made.select(
        "rule_path",
        "rule_verdict",
        F.concat("rule_host", "rule_path").alias("rule"),
        digest.alias("rule_digest"),
        F.substring(digest, 1, 8).alias("prefix"),
    )


def judge(
    pages: DataFrame,
    url_col: str = "url",
    rules: list[Rule] = RULES,
    default: str = DEFAULT,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``."""
    own = ["host", "path", "rule", "verdict"]
    base = pages.drop(*own)
    host, path = host_and_path(F.col(url_col))
    parts = base.withColumns({"host": host, "path": path})

    labels = max((r.host.count(".") + 1 for r in rules), default=0)
    slashes = max((r.path.count("/") for r in rules), default=0)
    # Each distinct address is matched once, however many pages share it.
    suffixes = (
        f"transform(sequence(1, least({labels}, size(split(host, '[.]')))), "
        "n -> substring_index(host, '.', -n))"
    )
    folders = (
        "concat(array(''), transform(sequence(1, 1 + least("
        f"{slashes}, length(path) - length(replace(path, '/', '')))), "
        "n -> concat(substring_index(path, '/', n), '/')))"
    )
    expressions = (
        parts.where("host != ''")
        .select("host", "path")
        .distinct()
        .select("host", "path", F.explode(F.expr(suffixes)).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.expr(folders)).alias("folder"))
        .where("startswith(path, folder)")
        .select("host", "path", F.sha2(F.concat("suffix", "folder"), 256).alias("digest"))
        .withColumn("prefix", F.substring("digest", 1, 8))
    )
    known = _rules(pages.sparkSession, rules)
    if len(rules) <= BROADCAST_RULES:
        known = F.broadcast(known)
    found = (
        expressions.join(known, "prefix")
        .where("digest = rule_digest and startswith(path, rule_path)")
        .groupBy("host", "path")
        .agg(
            F.max(F.struct(F.length("rule").alias("size"), "rule", "rule_verdict")).alias("best")
        )
        .select("host", "path", "best.rule", F.col("best.rule_verdict").alias("verdict"))
    )
    return parts.join(found, ["host", "path"], "left").select(
        *[parts[c] for c in base.columns],
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


OP3_SQL = r"""
WITH parts AS (
    SELECT page_id,
           CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END
               AS rest
    FROM pages
), split AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM parts
), rules(rule_host, rule_path, rule_verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
           ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, any_value(host) AS host, any_value(path) AS path,
       arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
       coalesce(arg_max(rule_verdict, length(rule_host || rule_path)), 'allow') AS verdict
FROM split
LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
               AND starts_with(path, rule_path)
GROUP BY page_id
"""
