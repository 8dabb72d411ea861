"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a host with a path prefix (``net/es/``, for the host and all its
subdomains) or a pattern over the whole URL (``*`` any text, ``^`` a
separator or the end, ``|`` the start or end). Each rule is filed under one
token: of the letter-and-digit runs that every matching URL holds as whole
tokens, the one that is rarest among all URLs. A URL's own tokens fetch
candidate rules from the index, and only those run their regular expression.

The index is a constant array of buckets inside the expression, so judging is
one row-local DataFrame expression: no join, no shuffle, no Python. Its size
is that of the rule list, a parameter. Token frequencies are counted over the
whole table, for the tokens of the rules only.

Verdict: the longest fitting host rule decides (ties: the longer host, then
block); else block if a pattern fits; else allow.

Defined cases. A NULL URL or one without ``://`` has empty host and path and
no host rule; patterns still run on a URL without ``://``. Repeated rows are
judged alike. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import row_with, with_row

TOKEN = "[a-z0-9]+"
_SEPARATOR = r"(?:[^a-z0-9_.%-]|$)"


@dataclass(frozen=True)
class HostRule:
    """``rule`` is host + path prefix, such as ``example.com/en/``."""
    verdict: str
    rule: str


@dataclass(frozen=True)
class PatternRule:
    """A pattern over the lower-cased URL; fitting URLs are blocked."""
    pattern: str


def _host_regex(rule: str) -> str:
    host, slash, path = rule.partition("/")
    return rf"^(?:[^/]*\.)?{re.escape(host.lower())}\x00{re.escape(slash + path)}"


def _pattern_regex(pattern: str) -> str:
    body = pattern.lower()
    start, end = body.startswith("|"), body.endswith("|")
    body = body.strip("|")
    parts = {"*": ".*", "^": _SEPARATOR}
    middle = "".join(parts.get(c) or re.escape(c) for c in body)
    return ("^" if start else "") + middle + ("$" if end else "")


def literal_tokens(rule: HostRule | PatternRule) -> set[str]:
    """Tokens that every fitting URL holds whole: runs with a literal boundary on both sides."""
    if isinstance(rule, HostRule):
        host, slash, path = rule.rule.partition("/")
        body = "." + host.lower() + slash + path.lower()  # a host or subdomain starts at a dot or at //
        closed_end = not path
    else:
        body, closed_end = rule.pattern.lower(), False
    out = set()
    for m in re.finditer(TOKEN, body):
        left = body[m.start() - 1] if m.start() else "*"
        right = body[m.end()] if m.end() < len(body) else ("/" if closed_end else "*")
        if left != "*" and right != "*":
            out.add(m.group())
    return out


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(url, F.lit(""))), F.lit(f"({TOKEN})"), 1))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def token_counts(urls: DataFrame, url_col: str, tokens: set[str]) -> dict[str, int]:
    """In how many rows each of the given tokens stands; bounded by the rule list."""
    wanted = F.array(*map(F.lit, sorted(tokens)))
    rows = (urls.select(F.explode(F.array_intersect(url_tokens(F.col(url_col)), wanted)).alias("token"))
            .groupBy("token").count().collect())
    return {r["token"]: r["count"] for r in rows}


def _index(rules: list, counts: dict[str, int]) -> list[list[dict]]:
    """Buckets of rule entries by the hash of the rule's rarest token ('' where it has none)."""
    buckets: list[list[dict]] = [[] for _ in range(max(1, 2 * len(rules)))]
    for rule in rules:
        tokens = literal_tokens(rule)
        token = min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t)) if tokens else ""
        is_host = isinstance(rule, HostRule)
        name = rule.rule if is_host else rule.pattern
        entry = {"token": token, "host_rule": is_host, "name": name,
                 "verdict": rule.verdict if is_host else "block",
                 "regex": _host_regex(name) if is_host else _pattern_regex(name),
                 "size": len(name), "host_size": len(name.partition("/")[0]) if is_host else 0}
        buckets[zlib.crc32(token.encode()) % len(buckets)].append(entry)
    return buckets


_ENTRY = ("array<array<struct<token:string,host_rule:boolean,name:string,verdict:string,regex:string,"
          "size:int,host_size:int>>>")


def judge_urls(urls: DataFrame, host_rules: list[HostRule], patterns: list[PatternRule] = (),
               url_col: str = "url") -> DataFrame:
    """Every input row with host, path, rule, verdict and pattern (a fitting pattern, else NULL)."""
    for r in host_rules:
        if "/" not in r.rule or r.verdict not in ("allow", "block"):
            raise ValueError(f"not a host rule: {r}")
    rules = [*host_rules, *patterns]
    tokens = set().union(*map(literal_tokens, rules)) if rules else set()
    buckets = _index(rules, token_counts(urls, url_col, tokens) if tokens else {})

    url = F.col(url_col)
    index = F.from_json(F.lit(json.dumps(buckets)), _ENTRY)
    own = F.array_union(url_tokens(F.col("_url")), F.array(F.lit("")))  # rules without a token are filed under ''
    place = lambda t: F.get(index, (F.crc32(t.cast("binary")) % len(buckets)).cast("int"))
    fetched = F.flatten(F.transform(own, lambda t: F.filter(place(t), lambda e: e["token"] == t)))
    # host and path are parted by NUL, so that a host rule cannot match across them
    split = F.concat("_host", F.lit("\x00"), "_path")
    fits = lambda e: F.regexp_like(
        F.when(e["host_rule"], split).otherwise(F.lower(F.coalesce("_url", F.lit("")))), e["regex"])
    hits = F.filter(fetched, lambda e: F.when(e["host_rule"], F.col("_host") != "").otherwise(F.lit(True)) & fits(e))
    order = lambda e: F.struct(e["size"], e["host_size"], e["verdict"], e["name"])
    best = F.array_max(F.transform(F.filter("_hits", lambda e: e["host_rule"]), order))
    pattern = F.array_min(F.transform(F.filter("_hits", lambda e: ~e["host_rule"]), lambda e: e["name"]))
    verdict = F.coalesce("_best.verdict", F.when(F.col("_pattern").isNotNull(), "block").otherwise("allow"))
    judged = (with_row(urls, url.alias("_url"), host_of(url).alias("_host"), path_of(url).alias("_path"))
              .withColumn("_hits", hits).withColumn("_best", best).withColumn("_pattern", pattern)
              .select("_row", F.struct(F.col("_host").alias("host"), F.col("_path").alias("path"),
                                       F.col("_best.name").alias("rule"), verdict.alias("verdict"),
                                       F.col("_pattern").alias("pattern")).alias("_judged")))
    return row_with(judged, urls.columns, "_judged")
