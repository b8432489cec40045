"""URL filters: pattern rules indexed by their rarest literal token. The tokens of a URL
fetch candidate rules, and only those run their regular expressions.

Native: DataFrame operations only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BROADCAST_RULES = 20_000

# Patterns of the default list: ``^`` is a boundary (an end of the URL or any character but
# ASCII letters and digits), ``*`` any run of characters; matched without regard to ASCII case.
BLOCK_PATTERNS = ("^adult^", "^porn^", "^xxx^", "^casino^", "^poker^", "^viagra^", "^torrent^", "^warez^",
                  "^phishing^", "^malware^", "^escort^")


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains with a path prefix, or (``host`` None) a ``pattern``."""
    verdict: str
    host: str | None = None
    path: str = ""
    pattern: str | None = None

    @property
    def name(self) -> str:
        return self.pattern if self.host is None else self.host + self.path

    @property
    def regex(self) -> str:
        """For a host rule over host || path, for a pattern over the lower-cased URL."""
        if self.host is not None:
            return r"(?s)\A(?:[^/]*\.)?" + re.escape(self.host) + (re.escape(self.path) if self.path else r"(?=/|\z)")
        parts = {"^": "(?:[^a-z0-9]|\\A|\\z)", "*": ".*"}
        return "(?s)" + "".join(parts.get(c) or re.escape(c) for c in self.pattern.translate(str.maketrans(UPPER, LOWER)))

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that every matching URL has: runs of letters and digits that the
        rule itself bounds on both sides."""
        text = "." + self.host + (self.path or "/") if self.host is not None else self.pattern
        text = text.translate(str.maketrans(UPPER, LOWER))
        return sorted({m[1] for m in re.finditer(r"(?<=[^a-z0-9*])([a-z0-9]+)(?=[^a-z0-9*])", text)})


# The five rules of the registered query (fixed values).
QUERY_RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
               Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))
DEFAULT_RULES = QUERY_RULES + tuple(Rule("block", pattern=p) for p in BLOCK_PATTERNS)


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` up to ``/ ? #`` (A-Z lower-cased) and path up to ``? #``;
    both empty when the URL is null or has no ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1)
    host = F.regexp_extract(rest, r"(?s)\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*(/[^?#]*)", 1)
    return _lower(host), path


def url_tokens(url: Column) -> Column:
    """Distinct lower-case runs of ASCII letters and digits, and the empty token under which
    rules without a literal token are kept."""
    return F.array_distinct(F.concat(F.split(_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"), F.array(F.lit(""))))


def _constants(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    return spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, names)]) for r in rows])))


def rule_index(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """``token, rank, regex, by_host``: every rule under the one of its literal tokens that
    occurs in the fewest URLs of ``urls`` (counted over all of them; ties to the smaller
    token), or under the empty token. A higher rank wins: host rules above patterns, then
    longer, then by name."""
    spark = urls.sparkSession
    order = sorted(rules, key=lambda r: (r.host is not None, len(r.name), r.name))
    literal = sorted({t for r in order for t in r.tokens})
    found = {}
    if literal:
        seen = urls.select(F.explode(url_tokens(F.col("url"))).alias("token"))
        tokens = _constants(spark, [(t,) for t in literal], ["_t"])
        seen = seen.join(F.broadcast(tokens) if len(literal) <= BROADCAST_RULES else tokens, F.col("token") == F.col("_t"), "left_semi")
        found = {r["token"]: r["count"] for r in seen.groupBy("token").count().collect()}  # a row per literal token of the rules
    rows = [(min(r.tokens, key=lambda t: (found.get(t, 0), t), default=""), k, r.regex, r.host is not None) for k, r in enumerate(order, 1)]
    return _constants(spark, rows, ["token", "rank", "regex", "by_host"])


def filter_urls(pages: DataFrame, rules: list[Rule] = DEFAULT_RULES, default: str = "allow") -> DataFrame:
    """Verdict of every row of ``pages`` (columns ``page_id, url`` are read).

    Returns ``page_id, url, host, path, rule`` (name of the winning host rule or null),
    ``pattern`` (of the winning pattern or null) and ``verdict``: that of the longest fitting
    host rule; else of the longest matching pattern; else ``default``. Null and empty URLs
    match nothing. Each row is judged on its own, so repeated rows and null ids come out as
    often as they go in; other columns are ignored; without rules all get ``default``.
    """
    rules = list(dict.fromkeys(rules))
    host, path = host_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("_rid"))
    if not rules:
        return rows.select("page_id", "url", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("pattern"), F.lit(default).alias("verdict"))
    index = rule_index(pages, rules)
    index = F.broadcast(index) if len(rules) <= BROADCAST_RULES else index
    fetched = rows.withColumn("token", F.explode(url_tokens(F.col("url")))).join(index, "token", "left")
    subject = F.when(F.col("by_host"), F.concat("host", "path")).otherwise(_lower(F.coalesce(F.col("url"), F.lit(""))))
    hit = F.when(F.col("regex").isNotNull() & F.rlike(subject, F.col("regex")), F.col("rank"))
    best = fetched.groupBy("_rid", "page_id", "url", "host", "path").agg(F.max(hit).alias("rank"))
    order = sorted(rules, key=lambda r: (r.host is not None, len(r.name), r.name))
    names = _constants(pages.sparkSession, [(k, r.name if r.host is not None else None, r.pattern, r.verdict) for k, r in enumerate(order, 1)], ["rank", "rule", "pattern", "_verdict"])
    names = names.withColumns({c: F.col(c).cast("string") for c in ("rule", "pattern", "_verdict")})
    names = F.broadcast(names) if len(rules) <= BROADCAST_RULES else names
    return best.join(names, "rank", "left").select("page_id", "url", "host", "path", "rule", "pattern", F.coalesce("_verdict", F.lit(default)).alias("verdict"))
