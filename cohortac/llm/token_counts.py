"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as a doubly linked list of symbols. A heap holds the adjacent pairs that have
a merge rank; the lowest rank (leftmost first on ties) is popped again and again, stale
entries are skipped, and the two symbols become one. The count is the number of initial
symbols minus the number of merges; no token ids are made.

Words repeat, so each worker remembers the counts of recent words (a bounded memo). Work is
one map over the documents: no shuffle.

Defined results: null text counts as empty, 0 bytes and 0 tokens; special token strings
inside a text count as one token each (the library's default); repeated rows and ids are
counted row by row; any extra columns pass through untouched by ``count_tokens``.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from tokenizers import Tokenizer

from cohortac.llm.pieces import BEYOND, LETTERS, NUMBERS, SPACES, Memo

MEMO_WORDS = 500_000

_WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


def merges_of(n_symbols: int, rank_of_pair, symbols: list[str]) -> int:
    """Number of merges byte-pair merging makes on ``symbols``; ``rank_of_pair(a, b)`` gives
    ``(rank, merged)`` or None."""
    after = list(range(1, n_symbols + 1))
    before = list(range(-1, n_symbols - 1))
    heap = []
    for i in range(n_symbols - 1):
        found = rank_of_pair(symbols[i], symbols[i + 1])
        if found:
            heap.append((found[0], i, found[1], symbols[i], symbols[i + 1]))
    heapq.heapify(heap)
    merges = 0
    while heap:
        _, i, merged, left, right = heapq.heappop(heap)
        j = after[i] if symbols[i] is not None else n_symbols
        if j >= n_symbols or symbols[i] != left or symbols[j] != right:
            continue  # one of the two has merged with another neighbour since
        merges += 1
        symbols[i], symbols[j] = merged, None
        k = after[i] = after[j]
        if k < n_symbols:
            before[k] = i
            if found := rank_of_pair(merged, symbols[k]):
                heapq.heappush(heap, (found[0], i, found[1], merged, symbols[k]))
        h = before[i]
        if h >= 0 and (found := rank_of_pair(symbols[h], merged)):
            heapq.heappush(heap, (found[0], h, found[1], symbols[h], merged))
    return merges


class WordCounter:
    """Counts the tokens of a text as the tokenizer file says."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        self.ranks = {(a, b): (rank, a + b) for rank, (a, b) in enumerate(pairs)}
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = re.compile("|".join(map(re.escape, specials))) if specials else None
        # Byte -> the character that stands for it, read off the library itself.
        byte_level = self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.shown = {}
        for c in map(chr, range(0x21, 0x180)):
            shown = "".join(s for s, _ in byte_level(c.lower()))
            raw = c.lower().encode()
            if len(shown) == len(raw):
                self.shown.update(zip(raw, shown))
        self.words = Memo(self._count_plain, MEMO_WORDS)
        self.shown_words = Memo(self._count, MEMO_WORDS)

    def _count(self, shown: str) -> int:
        """Tokens of one word given in its byte-level form."""
        symbols = list(shown)
        symbols[-1] += self.suffix
        n = len(symbols)
        pair = self.ranks.get
        return n - merges_of(n, lambda a, b: pair((a, b)), symbols)

    def _count_plain(self, word: str) -> int:
        shown = self.shown
        return self._count("".join([shown[b] for b in word.encode()]))

    def _span(self, text: str) -> int:
        if BEYOND.search(text):
            normal = self.tokenizer.normalizer.normalize_str(text)
            words = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            return sum(self.shown_words[w] for w, _ in words)
        return sum(map(self.words.__getitem__, _WORDS.findall(text.lower())))

    def count(self, text: str) -> int:
        if self.specials and "<" in text and (found := self.specials.findall(text)):
            return len(found) + sum(self._span(s) for s in self.specials.split(text) if s)
        return self._span(text)


@functools.lru_cache(maxsize=4)
def _counter(path: str) -> WordCounter:
    return WordCounter(path)


def token_count(text: Column, path: str) -> Column:
    """Tokens of ``text`` (null: 0) by the tokenizer file at ``path``, which every worker
    must be able to read."""

    @F.pandas_udf(LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _counter(path)
        for texts in batches:
            yield pd.Series([0 if t is None else counter.count(t) for t in texts], dtype="int64")

    return count(text)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit added (replacing columns of those names)."""
    whole = F.coalesce(docs[text], F.lit(""))
    return docs.withColumns(
        {"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_count(docs[text], path)}
    ).withColumn("over_limit", F.col("n_tokens") > limit)
