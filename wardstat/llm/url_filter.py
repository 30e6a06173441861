"""Operator 8: URL rules indexed by their rarest literal token (DataFrame functions only).

Each rule is (rule, action, host, path) plus an optional extra regular expression. A rule
compiles to one pattern over "host + path". Its literal tokens are the runs of letters and
digits in host and path; it is filed under the one that the fewest URLs of the table hold.
A URL is cut into its distinct tokens, the tokens fetch the rules filed under them, and only
those patterns run. Of the rules that match, the longest (host + path) wins, then the
smaller rule text.

Defined results: a URL that is null or has no "://" has empty host and path, matches no
rule and gets the default verdict; a rule without a token is tried on every URL; repeated
rows are judged alike, one result row each; empty table: no rows.
"""
from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored, take

MAX_BROADCAST_RULES = 100_000      # the rule index (some 100 bytes a rule) is broadcast up to this


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains; ``path`` is a literal prefix; ``regex`` (optional) must also
    match the path."""
    action: str
    host: str
    path: str = "/"
    regex: str = ""

    @property
    def rule(self) -> str:
        return self.host + self.path + (f"~{self.regex}" if self.regex else "")

    @property
    def pattern(self) -> str:
        tail = f"(?=.*(?:{self.regex}))" if self.regex else ""
        host = rf"(?:[^\u0000]*\.)?{re.escape(self.host)}" if self.host else r"[^\u0000]*"
        return rf"(?s)^{host}\u0000{tail}{re.escape(self.path)}"

    @property
    def tokens(self) -> list[str]:
        """Tokens that every matching URL holds whole: those of the host, and those of the path
        prefix that a further character of the prefix closes."""
        path = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", self.path)
        return sorted({*re.findall(r"[a-z0-9]+", self.host), *path})


# The rules of the contract.
RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"),
         Rule("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def judge(df: DataFrame, rules: list[Rule] = RULES, default: str = "allow", id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, url, host, path, rule, verdict): one row per input row.

    Distinct (host, path) pairs are judged once; tokens of one pair stay in one task, so the
    best rule is a map-side maximum. The rule list is the caller's and bounded by
    MAX_BROADCAST_RULES; beyond it the index is joined by shuffle.
    """
    spark = df.sparkSession
    pages = take(df, page_id=id_col, url=url_col).withColumn("url", F.col("url").cast("string")) \
              .withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    if not rules:
        return pages.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    compiled = spark.createDataFrame(
        [(r.rule, r.action, len(r.host) + len(r.path), r.pattern, r.tokens) for r in rules],
        "rule string, action string, len int, pattern string, tokens array<string>")
    hint = F.broadcast if len(rules) <= MAX_BROADCAST_RULES else (lambda x: x)
    urls = stored(pages.select("host", "path").distinct()
                  .withColumn("tokens", F.array_distinct(F.filter(
                      F.split(F.concat("host", F.lit("/"), "path"), "[^a-z0-9]+"), lambda t: t != ""))), "urls")
    wanted = compiled.select(F.explode("tokens").alias("token")).distinct()
    counts = (urls.select(F.explode("tokens").alias("token")).join(hint(wanted), "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    filed = (compiled.select("rule", F.explode_outer("tokens").alias("token")).join(hint(counts), "token", "left")
             .groupBy("rule").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    index = compiled.drop("tokens").join(filed, "rule")
    # rules without a token are filed under the empty one, which every URL holds
    index = stored(index.withColumn("token", F.coalesce("token", F.lit(""))), "url-rules")
    hits = (urls.select("host", "path", F.explode(F.concat("tokens", F.array(F.lit("")))).alias("token"))
            .join(hint(index), "token")
            .where(F.rlike(F.concat("host", F.lit("\u0000"), "path"), F.col("pattern")))
            .groupBy("host", "path")
            .agg(F.min_by(F.struct("rule", "action"), F.struct(-F.col("len"), "rule")).alias("best")))
    return (pages.join(hits, ["host", "path"], "left")
            .select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.action", F.lit(default)).alias("verdict")))


def judge_pages(pages: DataFrame) -> DataFrame:
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


ORACLE_SQL = r"""
WITH u AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(rule, action, rhost, rpath) AS (VALUES ('net/', 'block', 'net', '/'),
    ('example.net/en/', 'allow', 'example.net', '/en/'), ('example.com/de/', 'block', 'example.com', '/de/'),
    ('org/fr/', 'allow', 'org', '/fr/')),
best AS (SELECT page_id, host, path, rule, action,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) + length(rpath) DESC, rule) AS k
    FROM u JOIN r ON (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath))
SELECT u.page_id, u.host, u.path, best.rule, coalesce(best.action, 'allow') AS verdict
FROM u LEFT JOIN best ON best.page_id = u.page_id AND best.host = u.host AND best.path = u.path AND best.k = 1
"""
