"""URL rules by their rarest literal token (operator 7); DataFrame functions only.

A rule is a regular expression over host and path, with literal tokens that any URL it fits must
have: whole labels of the host and whole segments of the path. How many URLs have a token is counted
over all of them. Each rule is filed under its rarest token alone; a URL's tokens fetch the rules filed
under them, and only those run their expressions. A rule without literals is tried on every URL.

URLs are judged once per distinct host and path, so a URL that fills a third of the table costs one
row per map task. Null URLs and those without ``://`` have an empty host and path. A URL that no rule
fits is allowed. Null and repeated ``page_id``: one row out per row in. An empty table gives no rows.
Other columns are ignored. The rules are a list the caller writes, so a local table.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


@dataclass(frozen=True)
class Rule:
    """``literals``: tokens such as ``h:org`` (a host label) or ``p:en`` (a path segment)."""

    text: str
    verdict: str
    pattern: str
    literals: tuple[str, ...] = field(default=())

    @staticmethod
    def prefix(text: str, verdict: str) -> Rule:
        """``host/path``: the host and its subdomains, paths that start so."""
        host, slash, path = text.partition("/")
        whole = path.split("/")[:-1]  # the last segment may go on in the URL
        tokens = [f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in whole if x]
        return Rule(text, verdict, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(slash + path)}", tuple(tokens))


#: The rules of the contract.
RULES = (
    Rule.prefix("org/", "allow"),
    Rule.prefix("example.org/es/", "block"),
    Rule.prefix("example.org/en/1", "block"),
    Rule.prefix("com/fr/", "allow"),
    Rule.prefix("com/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url.cast("string"), F.lit(""))
    part = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(whole, part, 1), _UPPER, _LOWER), F.regexp_extract(whole, part, 2)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict``: the longest rule that fits, else none and allow."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    distinct = urls.select("host", "path").distinct()
    has = F.concat(
        F.transform(F.split("host", r"\."), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.split("path", "/"), lambda x: F.concat(F.lit("p:"), x)),
        F.array(F.lit("")),
    )
    tokens = distinct.select("host", "path", F.explode(F.array_distinct(has)).alias("token"))

    listed = spark.createDataFrame(
        [(r.text, r.verdict, r.pattern, list(r.literals) or [""]) for r in rules],
        "rule string, verdict string, pattern string, literals array<string>",
    )
    filed = listed.select("rule", "verdict", "pattern", F.explode("literals").alias("token"))
    known = filed.select("token").distinct()
    counts = tokens.join(known, "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    # A token that no URL has is the rarest of all: its rule then fetches nothing.
    rarest = (
        filed.join(counts, "token", "left")
        .groupBy("rule", "verdict", "pattern")
        .agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"))
    )
    fits = tokens.join(rarest, "token").filter(F.rlike(F.concat("host", "path"), F.col("pattern")))
    longest = F.max(F.struct(F.length("rule").alias("n"), "verdict", "rule"))
    best = fits.groupBy("host", "path").agg(longest.alias("best"))
    out = urls.join(best, ["host", "path"], "left")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit("allow")).alias("verdict"),
    )
