"""URL filters: a trie over reversed host labels and path segments.

Every rule is a host and a path prefix (``example.net/en/``). The trie holds
the labels of the host from the last to the first (``net``, ``example``) and,
below each host that ends a rule, the segments of the path. A rule fits its
host and all subdomains, if the url's path starts with the rule's. The longest
rule wins: more host labels first, then the longer path; of an allow and a
block entry of the same host and path, block wins. A url that no rule fits
gets ``default``.

The rules are a parameter of the job, not data of the tables. Tries are
broadcast in blocks of at most ``BLOCK_CHARS`` characters of rules, one column
expression for each, so no broadcast grows past that bound.

Defined results: a null url, or one without ``://``, has an empty host and an
empty path and gets ``default``; an empty path fits only rules without a path.
Very long urls and repeated rows are judged like any other; an empty table
gives an empty result. Columns of the input named like a result column are
replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partnerwatch.llm.common import LOWER, UPPER, free_prefix

BLOCK_CHARS = 16_000_000
_FOLD = str.maketrans(UPPER, LOWER)


class RuleTrie:
    """Longest match of (host, path) among rules."""

    def __init__(self) -> None:
        self.root: dict = {}

    def add(self, rule: str, verdict: str) -> None:
        host, slash, path = rule.partition("/")
        node = self.root
        for label in reversed(host.translate(_FOLD).split(".")):
            node = node.setdefault(label, {})
        *segments, tail = (slash + path).split("/")
        node = node.setdefault(None, ({}, {}))  # None: the paths below this host
        for segment in segments:
            node = node[0].setdefault(segment, ({}, {}))
        if node[1].get(tail, ("", ""))[1] != "block":
            node[1][tail] = (rule, verdict)

    @staticmethod
    def _longest_path(node: tuple, segments: list[str]) -> tuple[str, str] | None:
        best = None
        for segment in segments:
            below, tails = node
            if tails:
                best = next((tails[segment[:n]] for n in range(len(segment), -1, -1) if segment[:n] in tails), best)
            if segment not in below:
                break
            node = below[segment]
        return best

    def match(self, host: str, path: str) -> tuple[int, str, str] | None:
        """(host labels, rule, verdict) of the rule that wins."""
        node, best, segments = self.root, None, path.split("/")
        for depth, label in enumerate(reversed(host.split(".")), 1):
            node = node.get(label)
            if node is None:
                break
            if None in node and (found := self._longest_path(node[None], segments)):
                best = (depth, *found)
        return best


def _blocks(rules: Iterable[tuple[str, str]]) -> Iterator[list[tuple[str, str]]]:
    block, chars = [], 0
    for rule, verdict in rules:
        if verdict not in ("allow", "block"):
            raise ValueError(f"verdict of rule {rule!r}: {verdict!r}")
        if block and chars + len(rule) > BLOCK_CHARS:
            yield block
            block, chars = [], 0
        block.append((rule, verdict))
        chars += len(rule)
    if block:
        yield block


def _matches(df: DataFrame, rules: list[tuple[str, str]]) -> Column:
    trie = RuleTrie()
    for rule, verdict in rules:
        trie.add(rule, verdict)
    sent = df.sparkSession.sparkContext.broadcast(trie)

    @F.pandas_udf("labels int, length int, blocks int, rule string")
    def match(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        find = sent.value.match
        found = [find(h, p) or (-1, None, None) for h, p in zip(host, path)]
        return pd.DataFrame(
            {
                "labels": [d for d, _, _ in found],
                "length": [len(r or "") for _, r, _ in found],
                "blocks": [int(v == "block") for _, _, v in found],
                "rule": [r for _, r, _ in found],
            }
        ).astype({"rule": object})

    return match("host", "path")


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str]], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict."""
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    rest = F.coalesce(F.when(F.locate("://", F.col(url)) > 0, rest), F.lit(""))
    raw_host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw_host) + 1, F.length(rest)), "^[^?#]*", 0)
    out = pages.withColumns({"host": F.translate(raw_host, UPPER, LOWER), "path": path})
    found = [_matches(out, block) for block in _blocks(rules)]
    none = F.struct(F.lit(-1).alias("labels"), F.lit(0).alias("length"), F.lit(0).alias("blocks"), F.lit(None).cast("string").alias("rule"))
    best = F.greatest(none, *found) if found else none
    name = free_prefix(out)
    out = out.withColumn(name, best)
    verdict = F.when(F.col(f"{name}.labels") < 0, default).when(F.col(f"{name}.blocks") == 1, "block").otherwise("allow")
    return out.withColumns({"rule": F.col(f"{name}.rule"), "verdict": verdict}).drop(name)
