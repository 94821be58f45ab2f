"""Byte-level BPE encoding and decoding by dynamic programming over prefixes.

For every byte prefix of a piece there is exactly one encoding, so it has one last token.
The table stores that token for each prefix. The last token of a prefix of length ``i`` is
the one token ``t`` ending at ``i`` which, after the last token of the prefix it leaves, is
a pair that byte-pair merging would not have merged otherwise. Following the last tokens
from the end gives the ids.

* Appending bytes only adds entries: the encoding after an append is exact.
* After an edit, entries before it stay; entries after it are recomputed until as many in a
  row as the longest token has bytes agree with the old ones, from where the old ones hold.

Whole pieces repeat, so each worker keeps a bounded memo of pieces. One map, no shuffle.

Defined results: null text encodes as empty (no ids, empty decoding); special-token strings
are ordinary text; each row is encoded by itself, so repeated rows and ties need no rule.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.llm.pieces import Memo, splitter
from cohortac.llm.shared import free_name

MEMO_PIECES = 250_000
MEMO_PAIRS = 250_000


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank (= id) from a rank file: a base64 token and its rank per line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixEncoder:
    """Last tokens of prefixes under a rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.sizes = list(map(len, self.tokens))
        self.longest = max(self.sizes)
        # Tree of reversed tokens: byte -> node; a node's -1 is the token that ends there.
        self.root: dict = {}
        for token, i in ranks.items():
            node = self.root
            for byte in reversed(token):
                node = node.setdefault(byte, {})
            node[-1] = i
        self.halves = Memo(self._halves, len(ranks) + 1)
        self.holds = Memo(self._holds, MEMO_PAIRS)

    def merged(self, piece: bytes, stop: int = 1) -> list[bytes]:
        """Plain byte-pair merging: the lowest-ranked neighbours merge, leftmost first, until
        ``stop`` parts are left or nothing merges."""
        parts, ranks = [piece[i : i + 1] for i in range(len(piece))], self.ranks
        while len(parts) > stop:
            best, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _halves(self, token: int) -> tuple[int, ...]:
        """The two tokens whose merge makes ``token``; more if merging never makes it."""
        return tuple(self.ranks[part] for part in self.merged(self.tokens[token], 2))

    def _holds(self, pair: int) -> bool:
        """Whether tokens ``pair >> 20`` and ``pair & 0xFFFFF`` stay two tokens when their bytes
        are merged together. Merges are undone latest first; ``x | y`` are the parts beside
        the boundary, and they would have merged if their rank came before the merges that
        end x (which is further left, so wins a tie) and y."""
        x, y = pair >> 20, pair & 0xFFFFF
        x_ends = y_ends = 1 << 60
        tokens, ranks, sizes = self.tokens, self.ranks.get, self.sizes
        while True:
            rank = ranks(tokens[x] + tokens[y])
            if rank is not None and rank < x_ends and rank <= y_ends:
                return False
            x_made, y_made = x if sizes[x] > 1 else -1, y if sizes[y] > 1 else -1
            if x_made == y_made == -1:
                return True
            if x_made > y_made:
                x_ends, x = x, self.halves[x][-1]
            else:
                y_ends, y = y, self.halves[y][0]

    def extend(self, piece: bytes, last: list[int], start: int, stop: int | None = None) -> None:
        """Fill ``last[start:]``: ``last[i]`` is the last token of ``piece[:i + 1]``."""
        root, holds, sizes, halves, longest = self.root, self.holds, self.sizes, self.halves, self.longest
        del last[start:]
        for end in range(start, len(piece) if stop is None else stop):
            node, found = root, []
            for byte in piece[end : end - longest : -1] if end >= longest else piece[end::-1]:
                node = node.get(byte)
                if node is None:
                    break
                if -1 in node:
                    found.append(node[-1])
            for token in reversed(found):
                before = end - sizes[token]
                if holds[last[before] << 20 | token] if before >= 0 else sizes[token] < 2 or len(halves[token]) == 2:
                    last.append(token)
                    break
            else:
                raise ValueError("the rank table lacks a byte")

    def ids(self, piece: bytes, last: list[int]) -> list[int]:
        out, end = [], len(piece)
        while end:
            out.append(last[end - 1])
            end -= len(self.tokens[last[end - 1]])
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last: list[int] = []
        self.extend(piece, last, 0)
        return self.ids(piece, last)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class PrefixTable:
    """The encoding of one piece that grows or is edited."""

    def __init__(self, encoder: PrefixEncoder, piece: bytes = b""):
        self.encoder, self.piece, self.last = encoder, piece, []
        encoder.extend(piece, self.last, 0)

    def ids(self) -> list[int]:
        return self.encoder.ids(self.piece, self.last)

    def append(self, more: bytes) -> None:
        start, self.piece = len(self.piece), self.piece + more
        self.encoder.extend(self.piece, self.last, start)

    def replace(self, at: int, removed: int, put: bytes) -> int:
        """Replace ``removed`` bytes at ``at`` by ``put``; returns how many entries were made anew."""
        old, shift = self.last, len(put) - removed
        self.piece = self.piece[:at] + put + self.piece[at + removed :]
        self.last, agree = old[:at], 0
        for end in range(at, len(self.piece)):
            self.encoder.extend(self.piece, self.last, end, end + 1)
            same = end >= at + len(put) and self.last[end] == old[end - shift]
            agree = agree + 1 if same else 0
            if agree == self.encoder.longest:  # later entries only look back this far
                self.last += old[end + 1 - shift :]
                return end + 1 - at
        return len(self.piece) - at


class TextEncoder:
    """ids of whole texts: each match of ``pattern`` by itself."""

    def __init__(self, path: str, pattern: str):
        self.encoder = PrefixEncoder(read_ranks(path))
        self.split = splitter(pattern)
        self.known: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """ids of new pieces, in sorted order: a piece that shares its first bytes with the one
        before it appends to that prefix's table."""
        encoder, ranks, out, last, before = self.encoder, self.encoder.ranks, {}, [], b""
        for piece in sorted(pieces):
            raw = piece.encode()
            whole = ranks.get(raw)
            if whole is None:
                shared = 0
                for a, b in zip(before, raw):
                    if a != b:
                        break
                    shared += 1
                encoder.extend(raw, last, shared)
                before = raw
                out[piece] = array("I", encoder.ids(raw, last)).tobytes()
            else:
                out[piece] = whole.to_bytes(4, "little")
        return out

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        for group in grouped(texts):
            split = [self.split(text) for text in group]
            missing = set().union(*split).difference(self.known)
            if len(self.known) + len(missing) > MEMO_PIECES:
                self.known, missing = {}, set().union(*split)
            self.known.update(self._learn(missing))
            ids = self.known.__getitem__
            for pieces in split:
                yield b"".join(map(ids, pieces))

    def decode(self, ids: bytes) -> bytes:
        return self.encoder.decode(memoryview(ids).cast("I"))


@functools.lru_cache(maxsize=4)
def _tokens(path: str) -> dict[int, bytes]:
    return {i: token for token, i in read_ranks(path).items()}


def grouped(texts: list[str], size: int = 2_000_000) -> Iterator[list[str]]:
    """``texts`` in order, in groups of about ``size`` characters."""
    group, n = [], 0
    for text in texts:
        group.append(text)
        n += len(text)
        if n >= size:
            yield group
            group, n = [], 0
    if group:
        yield group


@functools.lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> TextEncoder:
    return TextEncoder(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary: little-endian unsigned 32-bit integers) and n_tokens."""

    @F.pandas_udf("binary")
    def ids_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(path, pattern)
        for texts in batches:
            yield pd.Series(list(encoder.encode(["" if t is None else t for t in texts])), dtype=object)

    return docs.withColumn("ids", ids_of(docs[text])).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``docs`` with ids, n_tokens and decoded, which is made
    from the ids. The ids do not travel between two Python steps, and a worker holds one encoder."""

    @F.pandas_udf("ids binary, decoded binary")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(path, pattern)
        for texts in batches:
            ids = list(encoder.encode(["" if t is None else t for t in texts]))
            yield pd.DataFrame({"ids": ids, "decoded": list(map(encoder.decode, ids))}, dtype=object)

    found = free_name(docs, "found")
    trip = docs.withColumn(found, both(docs[text]))
    parts = {"ids": F.col(found)["ids"], "decoded": F.col(found)["decoded"]}
    return trip.withColumns(parts).drop(found).withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (binary: the UTF-8 bytes the ids stand for)."""

    @F.pandas_udf("binary")
    def bytes_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokens = _tokens(path)
        for rows in batches:
            yield pd.Series([b"" if x is None else b"".join(map(tokens.__getitem__, memoryview(bytes(x)).cast("I"))) for x in rows], dtype=object)

    return encoded.withColumn("decoded", bytes_of(encoded[ids]))
