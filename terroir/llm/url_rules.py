"""URL filtering: pattern rules indexed by their rarest literal token.

A rule is a regular expression on `host + path` with a verdict and the literal
tokens every URL it matches must contain. Each rule is filed under the one of
its tokens that is rarest in the URLs at hand (counted over all of them); a
URL's tokens fetch candidate rules by an equi-join, and only those candidates
run their regular expressions. A rule without any literal token is tried on
every URL. The rule list is small and given by the caller; Spark decides from
its size how to join it.

Null URLs, and URLs without ``://``, have an empty host and path. Repeated rows
are judged each on its own, empty tables give no rows; only the id and URL
columns are read, whatever else the table holds. Ties between fitting rules of
one length: block before allow, then the larger rule text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOST = r"^[\s\S]*?://([^/?#]*)"
PATH = r"^[\s\S]*?://[^/?#]*([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """`text` is reported for rules proper and null for the method's own
    patterns; `rank` orders fitting rules (longest wins)."""

    text: str | None
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    rank: int


def host_path_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and all its subdomains when the path starts with `path`."""
    whole = path if re.search(r"[^A-Za-z0-9]$", path) else re.sub(r"[A-Za-z0-9]+$", "", path)
    tokens = [f"h:{t}" for t in re.split(r"[^a-z0-9]+", host) if t] + \
             [f"p:{t}" for t in re.split(r"[^A-Za-z0-9]+", whole) if t]
    quoted = "".join(c if c.isalnum() else f"\\{c}" for c in host), "".join(
        c if c.isalnum() or not c.isascii() else f"\\{c}" for c in path)
    # the line feed ends the host and starts the path: hosts hold no '/', paths start with one or are empty
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{quoted[0]}(?=/|$){quoted[1]}",
                tuple(dict.fromkeys(tokens)), len(host) + len(path))


def host_word_rule(word: str, verdict: str = "block") -> Rule:
    """The method's own pattern: `word` as a whole word of the host name."""
    return Rule(None, verdict, rf"^(?:[^/]*[.\-])?{word}(?:[.\-][^/]*)?(?:/|$)", (f"h:{word}",), -1)


# Host words of unwanted sites.
BLOCKED_HOST_WORDS = ["ads", "adult", "bets", "casino", "pills", "porn", "spam", "xxx"]
DEFAULT_PATTERNS = [host_word_rule(w) for w in BLOCKED_HOST_WORDS]


def split_url(url: Column) -> tuple[Column, Column]:
    lower = F.translate(F.regexp_extract(url, HOST, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                        "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    some = lambda c, split, mark: F.transform(F.filter(F.split(c, split), lambda t: t != ""),
                                              lambda t: F.concat(F.lit(mark), t))
    return F.array_distinct(F.concat(some(host, "[^a-z0-9]+", "h:"), some(path, "[^A-Za-z0-9]+", "p:")))


def rule_index(tokens: DataFrame, rules: list[Rule]) -> tuple[list[tuple[str, Rule]], list[Rule]]:
    """Rules by their rarest token (ties: the smaller token), and those without one.
    One count over all URLs, of the rules' own tokens only."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return [], list(rules)
    spark = tokens.sparkSession
    count = {r["token"]: r["n"] for r in tokens.join(spark.createDataFrame(pa.table({"token": wanted})), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()}
    filed = [(min(r.tokens, key=lambda t: (count.get(t, 0), t)), r) for r in rules if r.tokens]
    return filed, [r for r in rules if not r.tokens]


def judge_urls(pages: DataFrame, rules: list[Rule], patterns: list[Rule] | None = None,
               default: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict: the longest fitting rule's verdict, else
    that of the first fitting pattern, else `default`."""
    spark = pages.sparkSession
    every = list(rules) + list(DEFAULT_PATTERNS if patterns is None else patterns)
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    tokens = urls.select("page_id", "host", "path", F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
    filed, free = rule_index(tokens, every)
    hit = "struct<rank:int,block:int,rule:string,verdict:string>"
    best = lambda rank, verdict, rule: F.struct(rank.cast("int").alias("rank"), (verdict == "block").cast("int").alias("block"),
                                                rule.alias("rule"), verdict.alias("verdict"))
    tried = [F.when(F.concat("host", "path").rlike(r.pattern), best(F.lit(r.rank), F.lit(r.verdict), F.lit(r.text).cast("string")))
             for r in free]
    own = F.array_max(F.array_compact(F.array(*tried))) if tried else F.lit(None).cast(hit)
    found = urls.select("page_id", "host", "path", F.lit(1).alias("rows"), own.cast(hit).alias("hit"))
    if filed:
        # of Arrow data Spark knows the size: few rules are broadcast, many are joined by shuffle
        index = spark.createDataFrame(pa.table({
            "token": [t for t, _ in filed], "rule": pa.array([r.text for _, r in filed], pa.string()),
            "verdict": [r.verdict for _, r in filed], "pattern": [r.pattern for _, r in filed],
            "rank": pa.array([r.rank for _, r in filed], pa.int32())}))
        fetched = tokens.join(index, "token").filter(F.expr("rlike(concat(host, path), pattern)"))
        found = found.unionByName(fetched.select("page_id", "host", "path", F.lit(0).alias("rows"), best(
            F.col("rank"), F.col("verdict"), F.col("rule")).cast(hit).alias("hit")))
    return (found.groupBy("page_id", "host", "path").agg(F.sum("rows").alias("rows"), F.max("hit").alias("hit"))
            .select("page_id", "host", "path", F.col("hit.rule").alias("rule"),
                    F.coalesce("hit.verdict", F.lit(default)).alias("verdict"), "rows")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows")))).drop("rows", "copy"))
