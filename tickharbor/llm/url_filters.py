"""Verdicts on URLs by many rules, each looked at only for URLs that hold its rarest literal token.

Rules and URLs meet in a join on one token: a rule is indexed by that of its literal tokens which the fewest
URLs hold, a URL fetches the rules of each of its tokens, and only those run their regular expression. The index
is a staged table, so it is broadcast while small and joined by sorting, with hot tokens split, beyond.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import stage

# The site rules of the contract (host and path, verdict).
SITE_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]
# Words that mark a URL as unwanted when no site rule speaks; ^ is any non-alphanumeric, or an end.
PATTERN_RULES = [
    ("^adult^", "block"),
    ("^casino^", "block"),
    ("^escort^", "block"),
    ("^lottery^", "block"),
    ("^pills^", "block"),
    ("^poker^", "block"),
    ("^porn^", "block"),
    ("^viagra^", "block"),
    ("^warez^", "block"),
    ("^xxx^", "block"),
]
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[a-z0-9]+"


@dataclass(frozen=True)
class Rules:
    """Site rules, ``host/path``, which come first, and patterns with ``*`` and ``^``; each table is ``rule, verdict``."""

    sites: DataFrame
    patterns: DataFrame


def rules_of(spark: SparkSession, sites: Iterable[tuple[str, str]] = SITE_RULES, patterns: Iterable[tuple[str, str]] = PATTERN_RULES) -> Rules:
    schema = "rule string, verdict string"
    return Rules(spark.createDataFrame(list(sites), schema), spark.createDataFrame(list(patterns), schema))


def _folded(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def with_host_and_path(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (lower case) and ``path``; both are empty for NULL and for text without ``://``."""
    after = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*(/[^?#]*)?", 1)
    return pages.withColumns({"host": _folded(host), "path": path})


def _quoted(text: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _tokens(text: Column, pattern: str = _TOKEN) -> Column:
    return F.regexp_extract_all(_folded(text), F.lit(pattern), F.lit(0))


def _site_rules(rules: DataFrame) -> DataFrame:
    """A host with all its subdomains, and what the path begins with; the last token counts only if it is whole."""
    host, path = F.regexp_extract("rule", r"^[^/]*", 0), F.regexp_extract("rule", r"(?s)/.*$", 0)
    bound = F.when(path == "", F.lit("(?:/|$)")).otherwise(F.lit(""))
    regex = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), _quoted(_folded(host)), _quoted(path), bound)
    literals = F.concat(_tokens(host), _tokens(path, r"[a-z0-9]+(?=[^a-z0-9])"))
    return rules.select("rule", "verdict", F.lit(True).alias("site"), regex.alias("regex"), literals.alias("literals"))


def _pattern_rules(rules: DataFrame) -> DataFrame:
    """``*`` is any text; a token is literal if neither side of it is open to more letters."""
    edge = F.lit(r"\E(?:^|[^a-z0-9]|$)\Q")
    regex = F.replace(F.replace(_quoted(_folded(F.col("rule"))), F.lit("^"), edge), F.lit("*"), F.lit(r"\E.*\Q"))
    literals = _tokens(F.col("rule"), r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])")
    return rules.select(
        "rule", "verdict", F.lit(False).alias("site"), F.concat(F.lit("(?s)"), regex).alias("regex"), literals.alias("literals")
    )


def rule_index(tokens: DataFrame, rules: Rules) -> DataFrame:
    """``token, rule, verdict, site, regex``: each rule under the literal token that the fewest URLs hold.

    ``tokens``: one row per URL and token. A rule without a literal token stands under the empty one.
    """
    every = stage(_site_rules(rules.sites).unionByName(_pattern_rules(rules.patterns)).distinct(), "rules")
    literal = F.explode(F.when(F.size("literals") > 0, F.col("literals")).otherwise(F.array(F.lit(""))))
    listed = every.withColumn("token", literal).drop("literals")
    uses = tokens.join(listed.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    counted = listed.join(uses, "token", "left")
    rarest = F.min_by("token", F.struct(F.coalesce("uses", F.lit(0)), F.col("token"))).alias("token")
    return stage(counted.groupBy("rule", "verdict", "site", "regex").agg(rarest), "rule-index")


def judge_urls(pages: DataFrame, rules: Rules | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict, pattern`` of each row of ``pages`` (``page_id, url``).

    The longest site rule that fits host and path decides and is the ``rule``; without one, the longest pattern
    (``pattern``); without that, the URL is allowed. Of rules of one length the smaller text decides, and of one
    rule with several verdicts ``allow``. NULL URLs, empty ones and those without ``://`` have an empty host and
    path, which no rule but one without a literal token can fit. Equal URLs are judged once; every row has its own
    result, with NULL or repeated ids too; no rows give none; other columns are ignored.
    """
    rules = rules or rules_of(pages.sparkSession)
    parsed = with_host_and_path(pages.select("page_id", "url")).withColumn("target", F.concat("host", "path"))
    folded = F.concat("host", _folded(F.col("path")))
    targets = stage(parsed.select("target", folded.alias("folded"), F.col("target").alias("exact")).distinct(), "url-targets")
    named = F.array_distinct(F.concat(_tokens(F.col("folded")), F.array(F.lit(""))))
    tokens = targets.select("target", "folded", F.explode(named).alias("token"))
    fetched = tokens.join(rule_index(tokens, rules), "token")
    subject = F.when(F.col("site"), F.col("target")).otherwise(F.col("folded"))
    fitting = fetched.where(F.regexp_like(subject, F.col("regex")))
    first = F.struct(~F.col("site"), -F.length("rule"), F.col("rule"), F.col("verdict"))
    best = F.min_by(F.struct("rule", "verdict", "site"), first).alias("best")
    decided = stage(fitting.groupBy("target").agg(best), "url-verdicts")
    joined = parsed.join(decided, "target", "left")
    return joined.select(
        "page_id", "host", "path",
        F.when(F.col("best.site"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.verdict", F.lit(DEFAULT)).alias("verdict"),
        F.when(~F.col("best.site"), F.col("best.rule")).alias("pattern"),
    )
