"""URL allow and block rules in a trie over reversed host labels and path segments.

A rule is (action, host, path).  It fits a url when the url's host is the rule's host or a subdomain of it and
the url's path starts with the rule's path.  Of the fitting rules the longest (host and path characters
together) decides; equal lengths go to the longer host, then to ``block``.

Edge cases: a null url, or one without ``://``, has an empty host and path and fits only a rule with both empty;
an empty path does not start with ``/``; a rule with a null action, host or path fits nothing; repeated rows are judged one by one; an empty table gives an empty
result.  Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER

Rule = tuple[str, str, str]
#: A trie of this many rules stays below some 300 MB in a worker; more rules are joined instead.
MAX_TRIE_RULES = 500_000
_TAIL = re.compile(r"[?#]")
_RESULT = "host string, path string, rule string, verdict string"


def split_url(url: str | None) -> tuple[str, str]:
    """(host with A-Z lower-cased, path); both empty without ``://``."""
    start = url.find("://") if url is not None else -1
    if start < 0:
        return "", ""
    rest = _TAIL.split(url[start + 3:], maxsplit=1)[0]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(ASCII_LOWER), path


class UrlTrie:
    """Host labels from the right, then whole path segments; what follows the last ``/`` of a rule is a prefix."""

    HOST_END, PREFIXES = 0, 1  # keys that no label or segment (a string) can equal

    def __init__(self, rules: Iterable[Rule]):
        self.root: dict = {}
        for action, host, path in rules:
            host = host.translate(ASCII_LOWER)
            node = self.root
            for label in reversed(host.split(".")) if host else ():
                node = node.setdefault(label, {})
            node = node.setdefault(self.HOST_END, {})
            *whole, prefix = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            rank = (len(host) + len(path), len(host), action == "block")
            entry = (rank, host + path, action)
            ends = node.setdefault(self.PREFIXES, {})
            if prefix not in ends or ends[prefix] < entry:
                ends[prefix] = entry

    def match(self, host: str, path: str) -> tuple[str, str] | None:
        """(rule, action) of the longest fitting rule."""
        segments = path.split("/")
        best, node = None, self.root
        labels = reversed(host.split(".")) if host else iter(())
        while node is not None:
            for entry in self._path_entries(node.get(self.HOST_END), segments):
                if best is None or entry > best:
                    best = entry
            node = node.get(next(labels, None))
        return best and best[1:]

    def _path_entries(self, node: dict | None, segments: list[str]) -> Iterator[tuple]:
        for segment in segments:
            if node is None:
                return
            ends = node.get(self.PREFIXES)
            if ends:
                if len(ends) <= len(segment):
                    yield from (entry for prefix, entry in ends.items() if segment.startswith(prefix))
                else:
                    yield from (ends[segment[:n]] for n in range(len(segment) + 1) if segment[:n] in ends)
            node = node.get(segment)


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow",
               max_trie_rules: int = MAX_TRIE_RULES) -> DataFrame:
    """Key, host, path, deciding rule and verdict of every row.

    ``rules`` has the columns action, host and path.  Up to ``max_trie_rules`` of them are sent to the workers as
    one trie; a larger set is joined with the urls on their host suffixes, with the same result.
    """
    rules = rules.select("action", "host", "path").dropna()
    few = rules.limit(max_trie_rules + 1).collect()
    if len(few) > max_trie_rules:
        return _judge_by_join(pages, rules, key, url, default)
    trie = pages.sparkSession.sparkContext.broadcast(UrlTrie(tuple(row) for row in few))

    @F.pandas_udf(_RESULT)
    def judge(urls: pd.Series) -> pd.DataFrame:
        rows = []
        for text in urls:
            host, path = split_url(text)
            found = trie.value.match(host, path)
            rows.append((host, path, *(found or (None, default))))
        return pd.DataFrame(rows, columns=["host", "path", "rule", "verdict"])

    return pages.select(F.col(key), judge(F.col(url)).alias("_judged")).select(key, "_judged.*")


def _judge_by_join(pages: DataFrame, rules: DataFrame, key: str, url: str, default: str) -> DataFrame:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^?#]*)", 1))
    parts = pages.select(
        F.col(key), F.coalesce(rest, F.lit("")).alias("_rest")
    ).select(
        key,
        F.translate(F.regexp_extract("_rest", r"^[^/]*", 0), "".join(map(chr, ASCII_LOWER)),
                    "".join(ASCII_LOWER.values())).alias("host"),
        F.regexp_extract("_rest", r"(?s)/.*$", 0).alias("path"),
    )
    # rules fit (host, path) and nothing else, so each distinct pair is looked up once
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    asked = parts.select("host", "path").distinct().withColumn(
        "_suffix", F.explode(F.array_distinct(F.concat(suffixes, F.array(F.lit("")))))
    )
    known = rules.select(
        F.translate("host", "".join(map(chr, ASCII_LOWER)), "".join(ASCII_LOWER.values())).alias("_host"),
        F.col("path").alias("_path"), F.col("action").alias("_action"),
    )
    fits = asked.join(known, (F.col("_suffix") == F.col("_host")) & F.startswith("path", "_path"))
    rank = F.struct(
        F.length("_host") + F.length("_path"), F.length("_host"), F.col("_action") == "block"
    )
    best = fits.groupBy("host", "path").agg(
        F.max_by(F.struct(F.concat("_host", "_path").alias("rule"), F.col("_action").alias("verdict")), rank).alias("_b")
    )
    return parts.join(best, ["host", "path"], "left").select(
        key, "host", "path", F.col("_b.rule").alias("rule"), F.coalesce("_b.verdict", F.lit(default)).alias("verdict")
    )
