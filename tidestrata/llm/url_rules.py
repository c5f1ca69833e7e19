"""URL filter rules, found through their rarest literal token.

A rule is a regular expression and the literal tokens every URL it matches must hold. Each rule is
filed under the one of its tokens that fewest URLs have; a URL's own tokens then fetch the few rules
that can match, and only those run their expressions. Tokens are counted over all URLs.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidestrata.llm.common import ascii_lower, unused
from tidestrata.operators.bounds import broadcast_if_small

#: Tokens of hosts, paths and literals; rules are compared with ``host + path``.
TOKEN = "[a-z0-9]+"
RULE = "struct<rule: string, pattern: string, tokens: array<string>, verdict: string, named: boolean>"

#: General patterns for URLs that no named rule judges: word, verdict.
WORDS = (("casino", "block"), ("porn", "block"), ("xxx", "block"), ("viagra", "block"))


def site_rule(verdict: str, site: str) -> tuple:
    """A rule for a host with its subdomains and a path prefix, written ``host/path``.

    The last piece of a path without closing slash may go on in a URL, so it is no token. A rule
    with nothing but such a piece has no token and is filed under the empty one.
    """
    host, _, path = site.partition("/")
    pattern = rf"^([^/]*\.)?{re.escape(host)}/{re.escape(path)}"
    whole = "/".join(path.split("/")[:-1])
    return site, pattern, re.findall(TOKEN, f"{host}/{whole}".lower()), verdict, True


def word_rule(word: str, verdict: str) -> tuple:
    """A rule for a word that stands alone in host or path, whatever its case there."""
    return word, rf"(^|[^a-z0-9]){re.escape(word)}($|[^a-z0-9])", [word], verdict, False


def rule_table(spark: SparkSession, sites: Sequence[tuple[str, str]], words=WORDS) -> DataFrame:
    """Rules from (verdict, ``host/path``) pairs and (word, verdict) pairs."""
    rows = [site_rule(*x) for x in sites] + [word_rule(*x) for x in words]
    structs = [
        F.struct(F.lit(rule), F.lit(pattern), F.array(*map(F.lit, tokens)), F.lit(verdict), F.lit(named))
        for rule, pattern, tokens, verdict, named in rows
    ]
    return spark.range(1).select(F.inline(F.array(*structs).cast(f"array<{RULE}>")))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    rest = _after_scheme(url)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def tokens_of(place: Column) -> Column:
    """Distinct tokens of a host and path; the empty token, which every URL has, is added."""
    found = F.regexp_extract_all(ascii_lower(place), F.lit(f"({TOKEN})"), 1)
    return F.array_distinct(F.concat(found, F.array(F.lit(""))))


def rule_index(rules: DataFrame, places: DataFrame) -> DataFrame:
    """``rules`` with ``key``, the rarest of their tokens over ``places`` (place, n), ties by name.

    Rules without tokens get the empty key. Only tokens that rules have are counted.
    """
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = places.select("n", F.explode(tokens_of(F.col("place"))).alias("token"))
    counts = seen.join(broadcast_if_small(wanted), "token").groupBy("token").agg(F.sum("n").alias("n"))
    literal = rules.select("rule", "pattern", F.explode("tokens").alias("token"))
    keys = (
        literal.join(counts, "token", "left")
        .groupBy("rule", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("key"))
    )
    return rules.join(keys, ["rule", "pattern"], "left").withColumn("key", F.coalesce("key", F.lit("")))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule, pattern_rule and verdict of every URL.

    Of the named rules that match, the longest gives ``rule`` and the verdict, ties by name. Without
    one, the longest general pattern gives ``pattern_rule`` and the verdict, and without that the
    verdict is ``default``. A null URL or one without ``://`` has an empty host and path, which only
    rules without tokens could match. Each distinct host and path is judged once, so repeated URLs
    cost one row per task. Other columns stay; columns of ``pages`` named like the results are
    replaced. No rows give no rows.
    """
    place = unused(pages, "place")
    placed = pages.withColumn(place, F.concat(host_of(F.col(url)), path_of(F.col(url))))
    places = placed.groupBy(F.col(place).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    index = rule_index(rules, places)
    candidates = places.select("place", F.explode(tokens_of(F.col("place"))).alias("key")).join(
        broadcast_if_small(index), "key"
    )
    # Paths of named rules are case-sensitive; words are sought as tokens are, in lower case.
    seen = F.when(F.col("named"), F.col("place")).otherwise(ascii_lower(F.col("place")))
    matching = candidates.where(F.regexp_like(seen, F.col("pattern")))
    choice = F.struct(F.length("rule").alias("length"), "rule", "verdict")
    found = (
        matching.groupBy("place")
        .agg(
            F.max(F.when(F.col("named"), choice)).alias("site"),
            F.max(F.when(~F.col("named"), choice)).alias("pattern"),
        )
        .withColumnsRenamed({"place": "_place", "site": "_site", "pattern": "_pattern"})
    )
    clash = [c for c in found.columns if c in placed.columns]
    found = reduce(lambda f, c: f.withColumnRenamed(c, unused(placed, c)), clash, found)
    key, site, pattern = (F.col(c) for c in found.columns)
    return (
        placed.join(found, F.col(place) == key, "left")
        .withColumns(
            {
                "host": host_of(F.col(url)),
                "path": path_of(F.col(url)),
                "rule": site["rule"],
                "pattern_rule": F.when(site.isNull(), pattern["rule"]),
                "verdict": F.coalesce(site["verdict"], pattern["verdict"], F.lit(default)),
            }
        )
        .drop(place, *found.columns)
    )
