"""Best-fit-decreasing packing of token sequences into bins of a fixed capacity.

Documents of one length are interchangeable, so the packing is decided on the histogram of
lengths (at most ``capacity`` rows, whatever the input) and is exactly that of best-fit
decreasing document by document: lengths are taken from long to short, and a segment tree
over the remaining capacities finds the tightest open bin that still fits in logarithmic
time. A run of equal documents that goes to a run of equal bins is one step. The plan is a
bounded list of steps; each document finds its step by its rank among the documents of its
length, in a map over the documents.

Ranks are dealt out without bringing a length together in one task: documents of a length
are spread over groups of about ``GROUP_ROWS``, which start at the running totals of their
counts. The driver gets one count for each group.

Defined results: null text is empty; an empty document has the end token alone; a document
longer than the capacity is cut so that only its first piece may be shorter; repeated rows
are packed one by one, ties in order of ``doc_id`` within a salt group; an empty table gives
no pieces.
"""

from __future__ import annotations

import functools
import json
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortac.llm.pieces import splitter
from cohortac.llm.shared import free_name, written

GROUP_ROWS = 1 << 18
MEMO_PIECES = 600_000


class RemainingCapacities:
    """Segment tree over remaining capacities; a leaf is true if a bin with that much room is open."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, room: int, value: bool) -> None:
        i = self.size + room
        self.open[i] = value
        while i > 1:
            i //= 2
            self.open[i] = self.open[2 * i] or self.open[2 * i + 1]

    def tightest(self, need: int) -> int:
        """The smallest open room of at least ``need``, or -1."""
        i = self.size + need
        if self.open[i]:
            return need
        while i > 1:
            if not i & 1 and self.open[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.size
            i //= 2
        return -1


@dataclass
class Plan:
    """Steps in order of (length, first rank): documents of ``length`` with ranks from ``rank``
    on go ``per_bin`` to a bin, from bin ``first_bin`` and place ``offset`` on."""

    capacity: int
    length: np.ndarray
    rank: np.ndarray
    first_bin: np.ndarray
    per_bin: np.ndarray
    offset: np.ndarray
    bins: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bin, offset) of documents with these lengths and ranks within the length."""
        first = np.searchsorted(self.length, lengths)
        last = np.searchsorted(self.length, lengths, side="right")
        while (open_ := last - first > 1).any():  # the last step that starts at or before the rank
            middle = (first + last) // 2
            below = self.rank[np.minimum(middle, len(self.rank) - 1)] <= ranks
            first, last = np.where(open_ & below, middle, first), np.where(open_ & ~below, middle, last)
        past = ranks - self.rank[first]
        return self.first_bin[first] + past // self.per_bin[first], self.offset[first] + past % self.per_bin[first] * lengths


def plan_bins(histogram: dict[int, int], capacity: int) -> Plan:
    """Best-fit decreasing for ``histogram`` (length -> number of documents)."""
    tree, rooms = RemainingCapacities(capacity), {}  # room -> runs (first bin, number of bins)
    steps, bins = [], 0

    def put_back(room: int, first: int, n: int) -> None:
        if room and n:
            rooms.setdefault(room, []).append((first, n))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room < 0:  # new bins for all that is left
                room, first, n = capacity, bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            per_bin = room // length  # after one document the same bin is the tightest again
            full, some = divmod(left, per_bin)
            full = min(full, n)
            some = some if full < n and full == left // per_bin else 0
            used = full + bool(some)
            steps.append((length, rank, first, per_bin, capacity - room))
            put_back(room - per_bin * length, first, full)
            if some:
                put_back(room - some * length, first + full, 1)
            put_back(room, first + used, n - used)
            rank += full * per_bin + some
            left -= full * per_bin + some
    steps.sort()
    columns = np.array(steps, np.int64).reshape(-1, 5).T
    return Plan(capacity, *columns, bins)


def assign(pieces: DataFrame, capacity: int, key: list[str], length: str = "length") -> DataFrame:
    """``pieces`` (re-readable, e.g. a written table) with sequence_id and offset.

    ``key`` identifies a piece; lengths are 1 to ``capacity``.
    """
    salt, rank, start = free_name(pieces, "_salt"), free_name(pieces, "_rank"), free_name(pieces, "_start")
    histogram = {r[0]: r[1] for r in pieces.groupBy(length).agg(F.count(F.lit(1))).collect()}  # at most ``capacity`` rows
    groups = np.ones(capacity + 1, np.int64)  # of each length
    for n, count in histogram.items():
        groups[n] = -(-count // GROUP_ROWS)
    n_groups = F.element_at(F.lit(groups.tolist()), F.col(length).cast("int") + 1)
    salted = pieces.withColumn(salt, F.pmod(F.xxhash64(*key), n_groups))
    # One row a group: at most ``capacity`` and one for every GROUP_ROWS pieces.
    sizes = salted.groupBy(length, salt).agg(F.count(F.lit(1)).alias(start)).collect()
    opens = np.cumsum(groups) - groups  # the first group of each length in ``starts``
    starts, running = np.zeros(int(groups.sum()), np.int64), dict.fromkeys(histogram, 0)
    for n, s, count in sorted((r[0], r[1], r[2]) for r in sizes):
        starts[opens[n] + s] = running[n]
        running[n] += count
    plan = plan_bins(histogram, capacity)
    ranked = salted.withColumn(rank, F.row_number().over(Window.partitionBy(length, salt).orderBy(*key)) - 1)

    @F.pandas_udf("sequence_id long, offset long")
    def place(lengths: pd.Series, salts: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        n = lengths.to_numpy(np.int64)
        bin_, offset = plan.place(n, starts[opens[n] + salts.to_numpy(np.int64)] + ranks.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": bin_, "offset": offset})

    at = free_name(pieces, "_at")
    placed = ranked.withColumn(at, place(F.col(length), F.col(salt), F.col(rank)))
    return placed.withColumns({"sequence_id": F.col(at)["sequence_id"], "offset": F.col(at)["offset"]}).drop(salt, rank, at)


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level model's vocabulary, for ``str.translate``."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}


class LibraryIds:
    """ids of whole texts by the tokenizers library, which sees each distinct piece of text
    once in a while: pieces split as the library's pre-tokenizer does are remembered."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.split = splitter(pattern)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.specials = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None
        self.added = added
        self.known: dict[str, bytes] = {}
        # What a plain byte-level tokenizer does with a piece is its model's work alone.
        parts = json.loads(self.tokenizer.to_str())
        first = parts["pre_tokenizer"] or {}
        bare = all(parts[k] is None for k in ("normalizer", "truncation", "padding"))
        self.by_model = bare and first.get("type") == "ByteLevel" and not first["add_prefix_space"]
        self.letters = byte_letters()

    def _pieces(self, text: str) -> list[str]:
        if self.specials and "<" in text and self.specials.search(text):
            out = []
            for part in self.specials.split(text):
                out += [part] if part in self.added else self.split(part)
            return out
        return self.split(text)

    def _learn(self, new: list[str]) -> None:
        """Remember the ids of the pieces ``new``."""
        if not self.by_model:
            for piece, found in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                self.known[piece] = struct.pack(f"<{len(found.ids)}I", *found.ids)
            return
        model, letters, added = self.tokenizer.model, self.letters, self.added
        for piece in new:
            if piece in added:
                ids = [added[piece]]
            else:
                ids = [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(letters))]
            self.known[piece] = struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        for text in texts:
            pieces = self._pieces(text)
            try:
                yield b"".join(map(self.known.__getitem__, pieces))
                continue
            except KeyError:
                missing = set(pieces).difference(self.known)
            if len(self.known) + len(missing) > MEMO_PIECES:
                self.known, missing = {}, set(pieces)
            self._learn(list(missing))
            yield b"".join(map(self.known.__getitem__, pieces))


@functools.lru_cache(maxsize=2)
def _library(path: str, pattern: str) -> LibraryIds:
    return LibraryIds(path, pattern)


def token_pieces(docs: DataFrame, path: str, pattern: str, capacity: int, end_id: int, text: str = "text") -> DataFrame:
    """One row per piece of at most ``capacity`` tokens: the columns of ``docs`` without
    ``text``, and piece, start, length, ids (binary: little-endian unsigned 32-bit integers)."""
    end = int(end_id).to_bytes(4, "little")

    @F.pandas_udf("array<struct<piece:int,start:long,length:long,ids:binary>>")
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        library = _library(path, pattern)
        for texts in batches:
            out = []
            for ids in library.encode(["" if t is None else t for t in texts]):
                ids += end
                n = len(ids) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                out.append([{"piece": k, "start": a, "length": b - a, "ids": ids[4 * a : 4 * b]} for k, (a, b) in enumerate(zip(edges, edges[1:]))])
            yield pd.Series(out, dtype=object)

    kept = [docs[c] for c in docs.columns if c not in (text, "piece", "start", "length", "ids")]
    part = free_name(docs, "part")
    return docs.select(*kept, F.explode(cut(docs[text])).alias(part)).select(*kept, f"{part}.*")


def pack(pieces: DataFrame, capacity: int, key: list[str]) -> DataFrame:
    """``pieces`` with sequence_id and offset; the pieces are written once, so their making
    (tokenizing) is not repeated."""
    return assign(written(pieces, "pieces"), capacity, key)
