"""URL filter: pattern rules fetched by their rarest literal token.

A rule is ``(action, pattern)`` in the common filter-list notation: ``||`` binds
to a label boundary of the host, ``|`` to the start or end, ``*`` is any run,
``^`` one separator (or the end). *Site rules* such as ``example.com/en/`` (a
host suffix and a path prefix) are the same patterns bound to the host.

Every rule compiles to one regular expression and is indexed under one of the
whole tokens (``[a-z0-9]+``) that each matching url must contain: the one that
the fewest pages hold. A url's own tokens fetch its candidate rules, and only
those run their expressions. Rules without a whole token are tried on all urls.

Rules are parameters, so the index is bounded by the caller's list, not by the
data. Token counts come from one aggregate over all urls that keeps only tokens
of rules (a partial sum in each task, at most one row per rule token).

Defined results: a null url, or one without ``://``, has empty host and path
and is judged by the patterns on the whole url (null: the default). Repeated
rows are judged one by one; an empty table gives no rows. Among the site rules
that fit, the longest rule string wins, then the longer host, then the smaller
string. Without one, an allowing pattern beats a blocking one; of several, the
smallest pattern is named in ``matched``; with none, the default holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOWER = {i: i + 32 for i in range(65, 91)}
_TOKEN = re.compile("[a-z0-9]+")
_WORDY = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


class Rule(NamedTuple):
    action: str
    text: str
    site: bool = False

    @property
    def regex(self) -> str:
        if self.site:
            host, slash, rest = self.text.partition("/")
            return rf"(?:[^/?#]*\.)?{re.escape(host)}" + (re.escape(slash + rest) if slash else r"(?=[/?#]|\Z)")
        text, out = self.text, ""
        if text.startswith("||"):
            text, out = text[2:], r"[^:/?#]*://(?:[^/?#]*\.)?"
        elif text.startswith("|"):
            text = text[1:]
        else:
            out = ".*"
        end = text.endswith("|")
        text = text[:-1] if end else text
        out += "".join(".*" if c == "*" else r"(?:[^A-Za-z0-9_.%-]|\Z)" if c == "^" else re.escape(c) for c in text)
        return out + (r"\Z" if end else "")

    @property
    def tokens(self) -> list[str]:
        """Whole tokens that a matching url holds; ones that may go on are left out."""
        text = self.text.translate(_LOWER)
        bound_left = self.site or text.startswith("|")
        bound_right = (self.site and "/" not in text) or (not self.site and text.endswith("|"))
        text = text if self.site else text.strip("|")
        return [m[0] for m in _TOKEN.finditer(text)
                if (text[m.start() - 1] != "*" if m.start() else bound_left)
                and (text[m.end()] != "*" if m.end() < len(text) else bound_right)]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lowered."""
    host = F.regexp_extract(_after(url), r"\A([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after(url), r"\A[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def _tokens(url: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(
        F.translate(url, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit("([a-z0-9]+)"), F.lit(1)))


def token_counts(df: DataFrame, url_col: str, rules: list[Rule]) -> dict[str, int]:
    """Number of urls that hold each token of a rule; tokens in no url are absent."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    rows = (df.select(F.explode(F.array_intersect(_tokens(F.col(url_col)), F.array(*map(F.lit, wanted)))).alias("token"))
            .groupBy("token").count().collect())  # one row per rule token at most
    return {r["token"]: r["count"] for r in rows}


class RuleIndex:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.rules = rules
        self.by_token: dict[str, list[int]] = {}
        self.always: list[int] = []
        for i, rule in enumerate(rules):
            tokens = rule.tokens
            if tokens:
                self.by_token.setdefault(min(tokens, key=lambda t: (counts.get(t, 0), -len(t), t)), []).append(i)
            else:
                self.always.append(i)
        self._compiled: list[re.Pattern] | None = None

    def candidates(self, url: str) -> list[int]:
        found = list(self.always)
        for token in set(_TOKEN.findall(url.translate(_LOWER))):
            found += self.by_token.get(token, ())
        return found

    def judge(self, url: str | None, host: str, path: str, default: str) -> tuple[str | None, str, str | None]:
        """(site rule or None, verdict, matched pattern or None)."""
        if url is None:
            return None, default, None
        if self._compiled is None:
            self._compiled = [re.compile(r.regex, re.S) for r in self.rules]
        target = host + path
        fits = [self.rules[i] for i in self.candidates(url)
                if self._compiled[i].match(target if self.rules[i].site else url)]
        sites = [r for r in fits if r.site]
        if sites:
            best = min(sites, key=lambda r: (-len(r.text), -len(r.text.partition("/")[0]), r.text))
            return best.text, best.action, None
        if fits:
            best = min(fits, key=lambda r: (r.action != "allow", r.text))
            return None, best.action, best.text
        return None, default, None

    def __getstate__(self):
        return self.__dict__ | {"_compiled": None}


def filter_urls(df: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url",
                default: str = "allow") -> DataFrame:
    """One row per page: id, host, path, rule (site rule or null), verdict, matched (pattern or null)."""
    pages = df.select(F.col(id_col).alias(id_col), F.col(url_col).alias("_url"))
    index = RuleIndex(rules, token_counts(pages, "_url", rules))

    @F.pandas_udf("rule string, verdict string, matched string")
    def judged(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for urls, hosts, paths in batches:
            yield pd.DataFrame([index.judge(u, h, p, default) for u, h, p in zip(urls, hosts, paths, strict=True)],
                               columns=["rule", "verdict", "matched"], dtype=object)

    host, path = F.coalesce(url_host(F.col("_url")), F.lit("")), F.coalesce(url_path(F.col("_url")), F.lit(""))
    return (pages.select(id_col, "_url", host.alias("host"), path.alias("path"))
            .withColumn("_j", judged("_url", "host", "path"))
            .select(id_col, "host", "path", "_j.rule", "_j.verdict", "_j.matched"))
