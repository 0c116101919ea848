"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern for ``host + path``, a verdict, and a rank; of the rules that match a URL the one of highest rank
decides.  Every rule has literal tokens, the runs of letters and digits that any matching URL must contain as whole
tokens.  How often each such token occurs in the URLs is counted first (one aggregation; as many rows come back as the
rules have tokens), and a rule is filed under its rarest one.  A URL then looks up its own tokens and runs only the
patterns found there; rules without a literal token are run on every URL.

Judging is a narrow pass: nothing is shuffled, so a host that holds a third of all URLs is no harder than any other.
Rules are given by the caller in memory; the index goes to the tasks in shards of at most `SHARD_RULES` rules, and more
rules than that are simply further passes that carry the best rule so far.

Nulls and odd rows: a null URL, or one without ``://``, has empty host and path and meets no host rule; every row is
judged by itself, so repeated rows and null ids do not matter; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_RULES = 100_000
TOKEN = re.compile(r"[^\W_]+")
#: Neither part reaches over a line end differently than any other character.
PARTS = re.compile(r"(?s).*?://([^/?#]*)([^?#]*)")


@dataclass(frozen=True)
class Rule:
    """`pattern` is matched from the start of host + path; `tokens` are whole tokens of every URL that it matches."""

    name: str
    pattern: str
    verdict: str
    rank: int
    tokens: tuple[str, ...] = ()


def host_rule(host: str, path: str, verdict: str) -> Rule:
    """For a host and all its subdomains, where the URL's path starts with `path`; longer rules rank higher."""
    pattern = rf"(?s)(?:[^/?#]*\.)?{re.escape(host)}(?=/|\Z){re.escape(path)}"
    # The last run of a path may go on in the URL ("/en" fits "/english"); all others end where they do in the rule.
    closed = path if not path or TOKEN.fullmatch(path[-1]) is None else path[: [m.start() for m in TOKEN.finditer(path)][-1]]
    return Rule(host + path, pattern, verdict, len(host + path), tuple(TOKEN.findall(f"{host} {closed}")))


def split_url(url: str | None) -> tuple[str, str]:
    """Host with A-Z in lower case, and path; both empty without ``://``."""
    found = PARTS.match(url) if url is not None else None
    if not found:
        return "", ""
    host = found[1].translate(LOWER)
    return host, found[2]


LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def token_counts(pages: DataFrame, tokens: Sequence[str]) -> dict[str, int]:
    """In how many rows each of the given tokens occurs; at most one row per given token comes back."""
    wanted = set(tokens)

    def run(frames):
        counts: dict[str, int] = {}
        for frame in frames:
            for url in frame["url"]:
                host, path = split_url(url)
                for t in wanted.intersection(TOKEN.findall(f"{host} {path}")):
                    counts[t] = counts.get(t, 0) + 1
        yield pd.DataFrame(list(counts.items()), columns=["token", "n"])

    found = pages.select("url").mapInPandas(run, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in found.collect()}


def index(rules: Sequence[Rule], counts: dict[str, int]) -> dict[str | None, list[Rule]]:
    """Rules by their rarest token (by the token itself among equals); None for those without one."""
    filed: dict[str | None, list[Rule]] = {}
    for rule in rules:
        key = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default=None)
        filed.setdefault(key, []).append(rule)
    return filed


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """Per row: page_id, host, path, rule (null where none matches), verdict."""
    counts = token_counts(pages, [t for r in rules for t in r.tokens]) if rules else {}
    best = pages.select(
        F.col("page_id").cast("long").cast("string").alias("page_id"),  # as text: pandas would make floats beside nulls
        "url",
        F.lit("").alias("host"),
        F.lit("").alias("path"),
        F.lit(None).cast("string").alias("rule"),
        F.lit(default).alias("verdict"),
        F.lit(-1).cast("long").alias("rank"),
    )
    schema = "page_id string, url string, host string, path string, rule string, verdict string, rank long"
    for at in range(0, max(len(rules), 1), SHARD_RULES):
        filed = index(rules[at : at + SHARD_RULES], counts)

        def run(frames, filed=filed):
            compiled: dict[str, re.Pattern] = {}
            for frame in frames:
                rows = []
                for r in frame.itertuples(index=False):
                    host, path = split_url(r.url)
                    text, rank, name, verdict = host + path, r.rank, r.rule, r.verdict
                    for token in {None, *TOKEN.findall(f"{host} {path}")} & filed.keys():
                        for rule in filed[token]:
                            if rule.rank <= rank:
                                continue
                            if rule.pattern not in compiled:
                                compiled[rule.pattern] = re.compile(rule.pattern)
                            if compiled[rule.pattern].match(text):
                                rank, name, verdict = rule.rank, rule.name, rule.verdict
                    rows.append((r.page_id, r.url, host, path, name, verdict, rank))
                yield pd.DataFrame(rows, columns=frame.columns).astype({"rank": "int64"})

        best = best.mapInPandas(run, schema)
    return best.select(F.col("page_id").cast("long").alias("page_id"), "host", "path", "rule", "verdict")
