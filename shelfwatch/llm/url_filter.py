"""URL rules found through their rarest literal token.

A rule is a host with a path prefix, or a pattern with ``*``. Each has literal tokens, runs of
letters and digits that any fitting URL has as whole tokens. A rule is filed under the token that
fewest URLs have; a URL looks up its own tokens, and only the rules found run their regular
expression. Of the fitting rules the longest wins.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import free_names

#: rules that one pass holds; more rules go in blocks, one pass after another
BLOCK = 50_000
_TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``host/path`` fits the host and its subdomains if the path starts so; ``pattern`` the lower-cased URL.

    In a pattern ``*`` stands for anything; other characters for themselves.
    """

    verdict: str
    host: str = ""
    path: str = ""
    pattern: str = ""

    @property
    def name(self) -> str:
        return self.pattern or self.host + self.path

    def regex(self) -> str:
        """Over ``host#path``, or over the lower-cased URL for a pattern."""
        if self.pattern:
            return ".*".join(re.escape(p) for p in self.pattern.split("*"))
        return rf"(?:[^#]*\.)?{re.escape(self.host)}#{re.escape(self.path)}"

    def tokens(self) -> set[str]:
        """Whole tokens of every URL the rule fits: literal runs that can't be longer in the URL."""
        if self.pattern:
            found = [m for p in (self.pattern,) for m in _TOKEN.finditer(p)]
            inner = [m for m in found if 0 < m.start() and m.end() < len(self.pattern)]
            return {m[0] for m in inner if "*" not in (self.pattern[m.start() - 1], self.pattern[m.end()])}
        path = self.path.lower()
        cut = [m[0] for m in _TOKEN.finditer(path) if m.end() < len(path)]
        return set(_TOKEN.findall(self.host)) | set(cut)


# fixed values: the rules of the contract
BASE = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)

#: further patterns of pages that hold no prose; consulted where no base rule fits
PATTERNS = tuple(
    Rule("block", pattern=p)
    for p in (
        "/login/", "/login?", "/logout/", "/signup/", "/signin?", "/cart/", "/checkout/", "/wp-admin/", "/wp-login.",
        "/cgi-bin/", "/feed/", "/rss/", "/tag/", "/tags/", "/search?", "/search/", "?replytocom=", "&replytocom=",
        "/porn/", ".porn.", "/xxx/", ".xxx/", "/casino/", ".casino/", "/ads/", ".doubleclick.", "/sitemap.xml?",
    )
)


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path; both empty for null and for a URL without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return _lower(host), path


_UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _lower(text: str) -> str:
    return text.translate(_UPPER)


def token_counts(urls: DataFrame, tokens: set[str], url: str = "url") -> dict[str, int]:
    """How many rows have each of ``tokens``; as many entries as the rules have tokens."""
    low = F.translate(F.col(url), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = urls.select(F.explode(F.array_distinct(F.regexp_extract_all(low, F.lit("[a-z0-9]+"), F.lit(0)))).alias("t"))
    wanted = urls.sparkSession.createDataFrame([(t,) for t in sorted(tokens)], "t string")
    rows = found.join(F.broadcast(wanted), "t").groupBy("t").count().collect()
    return {t: 0 for t in tokens} | {r["t"]: r["count"] for r in rows}


def index(rules: Sequence[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """(rules by rarest token, rules without one)"""
    by_token: dict[str, list[int]] = {}
    rest = []
    for i, rule in enumerate(rules):
        if tokens := rule.tokens():
            by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), t)), []).append(i)
        else:
            rest.append(i)
    return by_token, rest


def judge(urls: DataFrame, rules: Sequence[Rule], url: str = "url", out: str = "judged", block: int = BLOCK) -> DataFrame:
    """``urls`` with the name, verdict and length of the longest fitting rule, the first of equals, or null.

    Every row is judged in its own place: no shuffle, so a frequent host is no hot key. The token
    counts read the URLs once.
    """
    counts = token_counts(urls, {t for r in rules for t in r.tokens()}, url)
    best = F.lit(None).cast("struct<name:string,verdict:string,length:int>")
    for start in range(0, len(rules), block):
        part = list(rules[start : start + block])
        found = _fit(urls.sparkSession.sparkContext.broadcast((part, *index(part, counts))))(F.col(url))
        longer = found["length"] > F.coalesce(best["length"], F.lit(-1))
        best = found if start == 0 else F.when(longer, found).otherwise(best)
    return urls.withColumn(out, best)


def _fit(sent):
    @F.pandas_udf("name string, verdict string, length int")
    def fit(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        rules, by_token, rest = sent.value
        compiled: dict[int, re.Pattern] = {}

        def longest(value: str | None) -> tuple[str | None, str | None, int | None]:
            host, path = host_and_path(value)
            low, where = _lower(value or ""), f"{host}#{path}"
            fits = None
            for i in {i for t in set(_TOKEN.findall(low)) for i in by_token.get(t, ())}.union(rest):
                if i not in compiled:
                    compiled[i] = re.compile(rules[i].regex(), re.S)
                run = compiled[i].search(low) if rules[i].pattern else compiled[i].match(where)
                if run and (fits is None or (-len(rules[i].name), i) < (-len(rules[fits].name), fits)):
                    fits = i
            return (None, None, None) if fits is None else (rules[fits].name, rules[fits].verdict, len(rules[fits].name))

        for batch in values:
            rows = pd.DataFrame([longest(v) for v in batch], columns=["name", "verdict", "length"])
            yield rows.astype({"length": "Int32"})

    return fit


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule] = BASE, patterns: Sequence[Rule] = PATTERNS, default: str = "allow", url: str = "url"
) -> DataFrame:
    """``pages`` with host, path, rule, pattern and verdict.

    ``rule`` is the longest fitting host rule and decides; else the longest fitting ``pattern``
    does, else ``default``. Null and odd URLs fit no host rule. The five result columns replace the
    caller's of the same names, all others stay. Of rules of equal length the first one counts.
    Repeated rows are judged alike; an empty table stays empty.
    """

    @F.pandas_udf("host string, path string")
    def parts(values: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in values:
            yield pd.DataFrame([host_and_path(v) for v in batch], columns=["host", "path"])

    # the url under a name of its own: a result column may replace the caller's
    own, cut, fits, also = free_names(pages.columns, "own", "parts", "fits", "also")
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "pattern", "verdict")]
    rows = pages.withColumn(own, F.col(url))
    rows = judge(judge(rows, rules, own, fits), patterns, own, also).withColumn(cut, parts(F.col(own)))
    return rows.select(
        *[f"`{c}`" for c in kept], F.col(f"{cut}.host").alias("host"), F.col(f"{cut}.path").alias("path"), F.col(f"{fits}.name").alias("rule"),
        F.when(F.col(f"{fits}.name").isNull(), F.col(f"{also}.name")).alias("pattern"),
        F.coalesce(f"{fits}.verdict", f"{also}.verdict", F.lit(default)).alias("verdict"),
    )
