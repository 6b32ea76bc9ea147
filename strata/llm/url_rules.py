"""URL filters: rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with literal tokens that every
URL it fits must contain as whole tokens (runs of a-z and 0-9). Each rule is filed under the
one of its tokens that the fewest URLs hold. The tokens of a URL fetch the rules filed under
them, and only those run their regular expression.

Cases: a null URL, or one without ``://``, has empty host and path and no tokens, so only
rules without any token can fit it. Repeated rows are judged each. Rules of equal length that
fit the same URL are settled by the smaller name. Columns other than the two named ones are
ignored. URLs of any length are read whole. An empty table or no rules at all give an empty result or default verdicts.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.text import ascii_lower
from strata.session import staged

TOKEN = "[a-z0-9]+"
# The rules come from the driver as a list, so their size is known before the join; up to
# this many characters the index is broadcast, beyond it the join shuffles.
BROADCAST_CHARS = 8_000_000
NULL_SPREAD = 1024


@dataclass(frozen=True)
class Rule:
    """``listed`` rules go before the others; among fitting ones the longest name wins."""

    name: str
    regex: str
    tokens: tuple[str, ...]
    verdict: str
    listed: bool


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains where the URL's path starts with ``path``."""
    host = host.lower()
    literal = host + path
    end = "" if path else "(?=/|\\z)"
    tokens = re.findall(TOKEN, literal.lower()) if path else re.findall(TOKEN, host)
    if tokens and path and re.search("[A-Za-z0-9]$", path):
        tokens = tokens[:-1]  # the last one may go on in the URL
    return Rule(literal, f"^(?:[^/]*\\.)?\\Q{literal}\\E{end}", tuple(tokens), verdict, True)


def word_rule(words: str, verdict: str) -> Rule:
    """Fits where the words stand in host or path, bounded by other characters."""
    words = words.lower()
    regex = f"(?i)(?:^|[^a-z0-9])\\Q{words}\\E(?:[^a-z0-9]|\\z)"
    return Rule(words, regex, tuple(re.findall(TOKEN, words)), verdict, False)


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0))
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    default: str = "allow",
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict, pattern.

    ``rule`` is the listed rule that decided; ``pattern`` the longest other rule that fits,
    which decides where no listed rule does; else the verdict is ``default``.
    """
    host, path = host_and_path(F.col(url_column))
    judged = pages.select(F.col(id_column).alias(id_column), F.col(url_column).alias("_url"),
                          host.alias("host"), path.alias("path"))
    # Staged, so that the rows of a URL that very many pages have can be split in the join.
    best = staged(pages.sparkSession, _best_rules(judged, rules), "url-rules")
    # Null URLs have no verdict to fetch; spread them so that they are no hot key.
    key = F.coalesce(
        F.col("_url"), F.concat(F.lit("\x00"), F.pmod(F.xxhash64(id_column), F.lit(NULL_SPREAD)))
    )
    found = judged.withColumn("_key", key).join(best, F.col("_key") == F.col("_best_url"), "left")
    verdict = F.coalesce("_listed.verdict", "_other.verdict", F.lit(default))
    return found.select(
        id_column, "host", "path", F.col("_listed.name").alias("rule"), verdict.alias("verdict"),
        F.col("_other.name").alias("pattern"),
    )


def _best_rules(judged: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    tokens = F.array_distinct(
        F.regexp_extract_all(ascii_lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0))
    )
    if any(not rule.tokens for rule in rules):
        tokens = F.concat(tokens, F.array(F.lit("")))
    urls = judged.filter(F.col("_url").isNotNull()).select(
        "_url", F.concat("host", "path").alias("_target"), F.explode(tokens).alias("_token")
    )
    index = rule_index(urls, rules)
    if sum(len(r.name) + len(r.regex) + 50 for r in rules) <= BROADCAST_CHARS:
        index = F.broadcast(index)
    fitting = urls.join(index, "_token").filter(F.expr("_target rlike regex"))
    order = F.struct(F.length("name"), F.expr("-rule_id"))
    rule = F.struct("name", "verdict")

    def best(listed: bool) -> Column:
        own = F.col("listed") if listed else ~F.col("listed")
        return F.max_by(F.when(own, rule), F.when(own, order))

    return fitting.groupBy(F.col("_url").alias("_best_url")).agg(
        best(True).alias("_listed"), best(False).alias("_other")
    )


def rule_index(urls: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rules with the rarest of their tokens; ``urls`` has a row per URL and token.

    Only the rules' own tokens are counted, at most one row per token and task is shuffled.
    """
    spark = urls.sparkSession
    ordered = sorted(rules, key=lambda r: (r.name, r.regex))
    rows = [(i, r.name, r.regex, r.verdict, r.listed, list(r.tokens) or [""])
            for i, r in enumerate(ordered)]
    table = spark.createDataFrame(
        rows, "rule_id int, name string, regex string, verdict string, listed boolean, "
        "tokens array<string>",
    )
    of_rules = table.select("rule_id", F.explode(F.array_distinct("tokens")).alias("_token"))
    wanted = of_rules.select("_token").distinct()
    if sum(len(t) + 50 for r in rules for t in r.tokens) <= BROADCAST_CHARS:
        wanted = F.broadcast(wanted)
    counts = urls.select("_token").join(wanted, "_token", "left_semi").groupBy("_token").agg(
        F.count(F.lit(1)).alias("_urls")
    )
    rarity = F.struct(F.coalesce("_urls", F.lit(0)), "_token")
    rarest = of_rules.join(counts, "_token", "left").groupBy("rule_id").agg(
        F.min_by("_token", rarity).alias("_token")
    )
    return table.drop("tokens").join(rarest, "rule_id")
