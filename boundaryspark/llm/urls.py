"""URL filters: host and path rules, then pattern rules found through their rarest literal token.

Method: a pattern rule is filed under one literal token that every URL it matches must hold as a whole
token, namely the one that is rarest among the tokens of all given URLs (counted by Spark).  The tokens
of a URL fetch its candidate rules, and only those run their regular expressions.  Rules without such a
token are candidates of every URL.  Rule lists are parameters of the job and are sent to the tasks; the
number of rules is checked against `max_rules`.

Pattern language: `||` start of a host label, `|` end of the URL, `^` a separator or the end, `*` anything.
A leading `@@` makes an exception, which allows.

Edge cases: null URLs and URLs without `://` have an empty host and path and can match no host rule;
equal rule lengths are settled by the order of the rules; repeated rows give repeated results.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boundaryspark.llm.common import append_columns, table
from boundaryspark.llm.registry import query

#: (verdict, host, path)
HOST_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
              ("allow", "com", "/fr/"), ("block", "com", "/de/")]
PATTERN_RULES = ["||spam-farm.", "||cheap-pills.", "||casino.", "||online-casino.", "/ads/", "/adserver/", "/popup/",
                 "://click.", "://tracker.", "/wp-login.php", "@@/legal/ads/"]
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
TOKEN = re.compile("[a-z0-9]+")
HOST = re.compile("://([^/?#]*)([^?#]*)")


def split_url(url: str | None) -> tuple[str, str]:
    found = HOST.search(url or "")
    return (found[1].translate(LOWER), found[2]) if found else ("", "")


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern rule, for URLs in lower case."""
    parts = []
    for piece in re.findall(r"^\|\||\|$|.", pattern.removeprefix("@@").lower(), re.S):
        parts.append({"||": r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?", "|": "$", "^": r"(?:[^a-z0-9_.%-]|$)",
                      "*": ".*"}.get(piece) or re.escape(piece))
    return "".join(parts)


def safe_tokens(pattern: str) -> list[str]:
    """Literal tokens that stand as whole tokens in every URL the pattern matches."""
    text = pattern.removeprefix("@@").lower()
    found = []
    for token in TOKEN.finditer(text):
        before, after = text[:token.start()], text[token.end():]
        if before and before[-1] != "*" and after and after[0] != "*":
            found.append(token[0])
    return found


class RuleIndex:
    def __init__(self, patterns: list[str], counts: dict[str, int], host_rules: list[tuple[str, str, str]]) -> None:
        self.always: list[int] = []
        self.by_token: dict[str, list[int]] = {}
        self.patterns = patterns
        self.compiled = [re.compile(pattern_regex(p), re.S) for p in patterns]
        for number, pattern in enumerate(patterns):
            tokens = safe_tokens(pattern)
            if tokens:
                rarest = min(tokens, key=lambda t: (counts.get(t, 0), t))
                self.by_token.setdefault(rarest, []).append(number)
            else:
                self.always.append(number)
        self.hosts: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, host, path in host_rules:
            self.hosts.setdefault(host, []).append((host + path, path, verdict))

    def host_rule(self, host: str, path: str) -> tuple[str | None, str | None]:
        best: tuple[str | None, str | None] = (None, None)
        labels = host.split(".")
        for i in range(len(labels)):
            for name, start, verdict in self.hosts.get(".".join(labels[i:]), ()):
                if path.startswith(start) and len(name) > len(best[0] or ""):
                    best = (name, verdict)
        return best

    def matches(self, url: str) -> list[str]:
        """Patterns that match, in rule order."""
        low = url.lower()
        candidates = set(self.always)
        for token in set(TOKEN.findall(low)):
            candidates.update(self.by_token.get(token, ()))
        return [self.patterns[n] for n in sorted(candidates) if self.compiled[n].search(low)]


def judge_urls(df: DataFrame, host_rules: list[tuple[str, str, str]] | None = None,
               patterns: list[str] | None = None, url: str = "url", max_rules: int = 200_000) -> DataFrame:
    """Add `host`, `path`, `rule`, `pattern` and `verdict`; host rules come before patterns, and no rule allows."""
    host_rules = HOST_RULES if host_rules is None else host_rules
    patterns = PATTERN_RULES if patterns is None else patterns
    if len(host_rules) + len(patterns) > max_rules:
        raise ValueError("more rules than max_rules, the bound of what every task holds")
    spark = df.sparkSession
    tokens = sorted({t for p in patterns for t in safe_tokens(p)})
    counts: dict[str, int] = {}
    if tokens:
        wanted = spark.createDataFrame([(t,) for t in tokens], "token string")
        seen = df.select(F.explode(F.array_distinct(F.split(F.lower(F.col(url)), "[^a-z0-9]+"))).alias("token"))
        counts = {r[0]: r[1] for r in seen.join(F.broadcast(wanted), "token").groupBy("token").count().collect()}

    state: list[RuleIndex] = []

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        if not state:
            state.append(RuleIndex(patterns, counts, host_rules))
        index, rows = state[0], []
        for x in batch.column(batch.schema.get_field_index(url)):
            address = x.as_py()
            host, path = split_url(address)
            rule, verdict = index.host_rule(host, path)
            matched = index.matches(address or "")
            pattern = next((p for p in matched if p.startswith("@@")), matched[0] if matched else None)
            if rule is None:
                verdict = "block" if pattern and not pattern.startswith("@@") else "allow"
            rows.append((host, path, rule, pattern, verdict))
        return [pa.array([r[k] for r in rows], pa.string()) for k in range(5)]
    return append_columns(df, [T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "pattern", "verdict")],
                          run)


_LABEL = r"^[a-z][a-z0-9+.-]*://(?:[^/?#]*\.)?"
OP4_SQL = rf"""
WITH parts AS (
  SELECT page_id, url, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path, lower(coalesce(url, '')) AS low
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
ruled AS (
  SELECT p.page_id, p.url, arg_max(r.rule_host || r.rule_path, length(r.rule_host || r.rule_path)) AS rule,
    arg_max(r.verdict, length(r.rule_host || r.rule_path)) AS verdict
  FROM (SELECT DISTINCT page_id, url, host, path FROM parts) p JOIN rules r
    ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
  GROUP BY p.page_id, p.url)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, CASE
    WHEN contains(p.low, '/legal/ads/') THEN 'allow'
    WHEN regexp_matches(p.low, '{_LABEL}(spam-farm|cheap-pills|casino|online-casino)\.')
      OR regexp_matches(p.low, '/(ads|adserver|popup)/|://(click|tracker)\.|/wp-login\.php') THEN 'block'
    ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN ruled r ON p.page_id IS NOT DISTINCT FROM r.page_id AND p.url IS NOT DISTINCT FROM r.url
"""


@query("op4_url_filter", OP4_SQL)
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
