"""Token counts of byte-level BPE with a whole-token shortcut.

Offline, every vocabulary string is merged once; those that end as one token are *proven*.  A text is cut into
pre-tokens; proven ones count one, only the rest are merged.  Since natural text repeats its words, the count of each
space-led stretch of a text is remembered in a table of bounded size.

Counts equal those of the tokenizers library for the same file, without added begin or end tokens; special strings
inside a text count as one token each.

Edge cases: null and empty texts have 0 bytes and 0 tokens; repeated rows are counted one by one; other columns of
the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from .common import Memo

#: remembered stretches in a generation of a worker's table, some 110 bytes each
MEMO = 500_000
#: letters that are one pre-token, with a mark that is another
_WORD = re.compile("[A-Za-z]+[,.]?")
#: white space beyond the ASCII kind, and characters near it: texts with these are cut as a whole
_ODD = re.compile("[" + "".join(map(chr, (
    *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    0xFEFF))) + "]")
_RUNS = tuple(" " + c for c in " \t\n\r\x0b\x0c")
_CUT = re.compile(r" (?=[^\s])")
_LOADED: dict[str, TokenCounter] = {}


def _merge_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Number of symbols left when the pair of lowest rank, leftmost first, is merged until none is known."""
    n = len(symbols)
    if n < 24:
        get, none = ranks.get, 1 << 60
        found = [get(pair, none) for pair in zip(symbols, symbols[1:])]
        while found and (least := min(found)) < none:
            at = found.index(least)
            symbols[at] += symbols.pop(at + 1)
            del found[at]
            if at:
                found[at - 1] = get((symbols[at - 1], symbols[at]), none)
            if at < len(found):
                found[at] = get((symbols[at], symbols[at + 1]), none)
        return len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(rank, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (rank := ranks.get((a, b))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue
        symbols[i], symbols[j] = a + b, ""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        left -= 1
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (rank := ranks.get((symbols[x], symbols[y]))) is not None:
                heapq.heappush(heap, (rank, x, symbols[x], symbols[y]))
    return left


class TokenCounter:
    """``spec`` is the text of a tokenizer file: byte-level BPE without normaliser or prefix space."""

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model, cutter = parsed["model"], parsed["pre_tokenizer"]
        if (parsed["normalizer"] or model["type"] != "BPE" or cutter["type"] != "ByteLevel"
                or cutter["add_prefix_space"] or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("the shortcut is proven for plain byte-level BPE only")
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.pre_tokens = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=cutter.get("use_regex", True))
        self.whole = self.prove(model["vocab"])
        special = sorted((t["content"] for t in parsed["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.special_strings = special
        self.space = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(" ")[0][0]
        self.plain_marks = cutter.get("use_regex", True) and {",", "."} <= self.whole
        self.led = Memo(self._led, MEMO)

    def prove(self, vocabulary) -> frozenset[str]:
        """The vocabulary strings that encode alone as one token."""
        return frozenset(s for s in vocabulary if _merge_count(list(s), self.ranks) == 1)

    def _led(self, word: str) -> int:
        """Tokens of a word with the space before it."""
        if self.plain_marks and _WORD.fullmatch(word):
            marks = not word[-1].isalpha()
            piece = self.space + (word[:-1] if marks else word)
            return marks + (1 if piece in self.whole else _merge_count(list(piece), self.ranks))
        return self.stretch(" " + word)

    def stretch(self, text: str) -> int:
        """Tokens of a text without special strings."""
        total = 0
        for piece, _ in self.pre_tokens.pre_tokenize_str(text):
            total += 1 if piece in self.whole else _merge_count(list(piece), self.ranks)
        return total

    def _plain(self, text: str) -> int:
        if _ODD.search(text):
            return self.stretch(text)
        # a single space before other text starts a pre-token, whatever stands before it
        if any(run in text for run in _RUNS):
            first, *rest = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
            if rest and not rest[-1]:  # the text ends with a space
                rest.pop()
                return self.stretch(first) + sum(map(self.led.__getitem__, rest)) + self.stretch(" ")
        return self.stretch(first) + sum(map(self.led.__getitem__, rest))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if not any(s in text for s in self.special_strings):
            return self._plain(text)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(self._plain(part) for part in parts if part)


def _counter(spec: str) -> TokenCounter:
    """One counter for each worker and tokenizer."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = TokenCounter(spec)
    return _LOADED[key]


def count_tokens(rows: DataFrame, tokenizer_file: str, key: str = "doc_id", text: str = "text",
                 limit: int = 1024) -> DataFrame:
    """Key, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    The driver reads the tokenizer's file and sends its text (some 1.5 MB) to the workers.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        spec = rows.sparkSession.sparkContext.broadcast(file.read())

    @F.pandas_udf("n_bytes long, n_tokens long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = _counter(spec.value)
        for texts in batches:
            yield pd.DataFrame({
                "n_bytes": [len(t.encode()) if t else 0 for t in texts],
                "n_tokens": [counter.count(t) for t in texts],
            })

    return rows.select(F.col(key), counted(F.col(text)).alias("_n")).select(
        key, "_n.n_bytes", "_n.n_tokens", (F.col("_n.n_tokens") > limit).alias("over_limit"))
