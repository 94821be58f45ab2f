"""Removal of repeated passages: every byte covered by a string of ``length`` bytes that also
starts earlier (in a smaller id, or earlier in the same document).

Equal strings are brought together by their anchors and found by suffix sorting:

1. The anchor of a ``length``-byte window is the place of its least-hashed ``GRAM``-byte string (the
   leftmost on ties), which depends on nothing but the window's bytes. Windows that follow each
   other mostly share an anchor and make one segment. Equal windows have equal anchor strings, so
   only segments whose anchor hash occurs again can hold a repeat: anchors are dealt out and sorted by
   hash, and those without a neighbour drop out. Of a hash that a batch has more than once only one
   place is sent by its hash, so a hot hash sends a row per batch to its task.
2. The segments that are left are dealt into shards by anchor hash. Equal segments are one entry
   that stands for its earliest copy; every other copy is a repeat as a whole. An anchor
   with one entry has nothing to compare it with, as windows of one segment differ. The windows of a
   hot anchor (more than ``HOT`` segments) are dealt anew by the bytes to its left or, if they hold too few of
   them, to its right, and again in ever longer strings while one is hot, at last by all their bytes.
   Equal windows hold the same bytes around the anchor and stay together.
3. A shard's entries are joined, each ended by a symbol of its own, and sorted by external
   induced suffix sorting with common-prefix values (``suffix_sort``). Suffixes whose common
   prefixes reach ``length`` are equal windows; all but the earliest are repeats.

The number of shards follows from the bytes of the input, so a task's work stays bounded; a shard is
sorted from arrays in memory. The sort's queues go to the task's scratch disk when they exceed their memory.

Defined results: null text is empty and nothing of it is removed; texts of less than ``length``
bytes lose nothing; rows that repeat both id and text count as one document (both get its
result); a null id comes before all others; rows that share an id but not the text are ordered by a
hash of the text. Matches are judged on the input and never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xxhash import xxh64_intdigest

from cohortac.llm.shared import bound_batches, free_name, written
from cohortac.llm.simhash import whole_groups
from cohortac.llm.suffix_sort import suffix_order

LENGTH = 100
GRAM = 32
SHARD_BYTES = 2_000_000
ROWS = 100_000
HOT = 10_000
BROADCAST_BYTES = 64_000_000
GROUP_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_MIX = 0xBF58476D1CE4E5B9


def gram_hashes(data: np.ndarray, gram: int = GRAM, kind: type = np.uint64) -> np.ndarray:
    """A hash of the ``gram`` bytes (a power of two) from every place, as a number of ``kind``."""
    bits = 8 * np.dtype(kind).itemsize
    h, factor, size = data.astype(kind) + kind(1), _ODD % (1 << bits), 1
    while size < gram:
        h = h[:-size] * kind(factor) + h[size:]
        factor, size = factor * factor % (1 << bits), 2 * size
    h = (h ^ (h >> kind(bits // 2 - 3))) * kind(_MIX % (1 << bits))
    return h ^ (h >> kind(bits // 2))


def gram_hashes_at(data: np.ndarray, places: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """``gram_hashes`` of ``places`` alone."""
    h, factor = np.lib.stride_tricks.sliding_window_view(data, gram)[places].T.astype(np.uint64) + np.uint64(1), _ODD
    while len(h) > 1:
        h, factor = h[::2] * np.uint64(factor) + h[1::2], factor * factor % (1 << 64)
    h = (h[0] ^ (h[0] >> np.uint64(29))) * np.uint64(_MIX)
    return h ^ (h >> np.uint64(32))


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """``best`` over every ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values, size = best(values[:-size], values[size:]), 2 * size
    return best(values[: len(values) - (width - size)], values[width - size :]) if size < width else values


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of all segments of documents that lie one
    after the other in ``data`` and end at ``ends``."""
    sizes = np.diff(ends, prepend=0)
    begins, stops = (ends - sizes)[sizes >= length], (ends - length + 1)[sizes >= length]
    if not len(begins):
        return (np.zeros(0, np.int64),) * 3
    # Hashes of 4 bytes tell the anchors apart; only theirs are needed in full.
    h, width = gram_hashes(data, gram, np.uint32), length - gram + 1
    least = sliding(h, width)
    # A place is some window's least if it equals the largest least of the windows that hold it.
    edge = np.zeros(width - 1, np.uint32)
    places = np.flatnonzero(h == sliding(np.concatenate([edge, least, edge]), width, np.maximum))
    # One that equals the place before is the leftmost of a window only if it is so in the first without that place.
    after, value = np.minimum(places[:-1] + 1, len(least)), h[places]
    leftmost = (value[1:] != value[:-1]) | (np.append(least, 0)[after] == value[1:]) & (after < len(least))
    anchors = places[np.concatenate(([True], leftmost))]
    # An anchor takes over when it comes into the window, if it is smaller, or when the one before it has left.
    value = h[anchors]
    opens = np.concatenate(([0], np.where(value[1:] < value[:-1], anchors[1:] - width + 1, anchors[:-1] + 1)))
    cuts = np.unique(np.concatenate([opens, begins, stops]))
    whole = cuts < stops[np.maximum(np.searchsorted(begins, cuts, side="right") - 1, 0)]
    whole &= cuts >= begins[0]
    starts, n = cuts[whole], np.diff(cuts, append=len(least))[whole]
    own = anchors[np.searchsorted(opens, starts, side="right") - 1]
    return starts, n, gram_hashes_at(data, own, gram).view(np.int64)


def _groups(batch: pd.DataFrame) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray, tuple]]:
    """(rows, their texts, first byte of each in the group, segments) of about GROUP_BYTES at a time."""

    def cut(rows: np.ndarray, own: list[bytes]) -> tuple:
        sizes = np.array([len(t) for t in own], np.int64)
        ends = np.cumsum(sizes)
        starts, n, h = segments(np.frombuffer(b"".join(own), np.uint8), ends)
        row = np.searchsorted(ends, starts, side="right")
        return rows, own, row, (starts - (ends - sizes)[row], n, h)

    own, size = [], 0
    for k, text in enumerate(batch["text"], 1):
        own.append(text.encode("utf-8", "replace"))
        size += len(own[-1])
        if size >= GROUP_BYTES or k == len(batch):
            yield cut(np.arange(k - len(own), k), own)
            own, size = [], 0


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchors by hash, about ``ROWS`` at a time. A hash that comes more than once in them is sent by its
    hash once, to be seen by others; its other places are known to repeat and are spread (``deal`` is
    not the hash). ``seen`` is the number of places of a hash on the row that is sent by it, 0 on others."""

    def dealt(found: list[tuple]) -> pd.DataFrame:
        h, id_, th, lo = map(np.concatenate, zip(*found))
        _, first, counts = np.unique(h, return_index=True, return_counts=True)
        seen, sent = np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        sent[first] = True
        seen[first] = counts
        spread = (id_.astype(np.uint64) * np.uint64(_ODD) + lo.astype(np.uint64) * np.uint64(_MIX)).view(np.int64)
        return pd.DataFrame({"deal": np.where(sent, h, spread), "seen": seen, "id": id_, "th": th, "lo": lo})

    for batch in batches:
        ids, hashes, found, n = batch["id"].to_numpy(), batch["th"].to_numpy(), [], 0
        for rows, _, row, (lo, _, h) in _groups(batch):
            found.append((h, ids[rows][row], hashes[rows][row], lo))
            n += len(h)
            if n >= ROWS:
                yield dealt(found)
                found, n = [], 0
        if found:
            yield dealt(found)


def _repeating(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by ``deal`` those known to repeat and those with a neighbour of the same value. A
    hash of more than ``HOT`` places is told by a row without an id that has it as ``th``."""

    def hot(hashes: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"id": pd.array([None] * len(hashes), "Int64"), "th": hashes, "lo": np.zeros(len(hashes), np.int32)})

    held, held_again, places = None, False, 0
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        deal, seen = batch["deal"].to_numpy(), batch["seen"].to_numpy()
        again = seen != 1
        same = deal[1:] == deal[:-1]
        again[1:] |= same
        again[:-1] |= same
        again[0] |= held_again
        starts = np.concatenate(([0], np.flatnonzero(~same) + 1))
        totals = np.add.reduceat(seen, starts)
        totals[0] += places
        # The last row may have its neighbour in the next batch.
        held, held_again, places = batch.iloc[-1:], bool(again[-1]), int(totals[-1] - seen[-1])
        yield batch.iloc[:-1][again[:-1]][["id", "th", "lo"]]
        yield hot(deal[starts[:-1]][totals[:-1] > HOT])
    if held is not None:
        if held_again:
            yield held[["id", "th", "lo"]]
        if places + held["seen"].iloc[0] > HOT:
            yield hot(held["deal"].to_numpy())


def _cut_segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Segments at the places ``found``, with their bytes; of equal ones in about ``ROWS`` only the
    earliest keeps the bytes. A repeated row of a document adds nothing."""
    columns = ["h", "id", "th", "lo", "n"]

    def cut(found: list[tuple], parts: list) -> pd.DataFrame:
        whole = [np.concatenate(x) for x in zip(*found)] or [np.zeros(0, np.int64)] * len(columns)
        return pd.DataFrame(dict(zip(columns, whole))).assign(part=pd.Series(parts, dtype=object))[["h", "part", *columns[1:]]]

    for batch in batches:
        batch = batch.drop_duplicates(["id", "th"]).sort_values(["id", "th"], kind="stable", ignore_index=True)
        ids, hashes, found, parts, seen = batch["id"].to_numpy(), batch["th"].to_numpy(), [], [], set()
        for own, texts, row, (lo, n, h) in _groups(batch):
            wanted = np.sort(np.concatenate([np.asarray(x, np.int64) + (k << 40) for k, x in enumerate(batch["found"].iloc[own])]))
            places = lo + (row << 40)  # ascending
            at = np.minimum(np.searchsorted(places, wanted), max(len(places) - 1, 0))
            at = np.unique(at[places[at] == wanted]) if len(places) else np.zeros(0, np.int64)
            row, lo, n = row[at], lo[at], n[at]
            for k, a, b in zip(row.tolist(), lo.tolist(), (lo + n + LENGTH - 1).tolist()):
                part = texts[k][a:b]
                if part in seen:
                    parts.append(None)
                else:
                    seen.add(part)
                    parts.append(part)
            found.append((h[at], ids[own[row]], hashes[own[row]], lo, n))
            if len(parts) >= ROWS:
                yield cut(found, parts)
                found, parts, seen = [], [], set()
        yield cut(found, parts)


def narrowed(part: bytes, n: int, start: int, stop: int) -> list[tuple[int, int, int, int, int]]:
    """(first window, number of windows, key, start, stop) of the one or two pieces that the ``n`` windows of ``part``,
    which all hold its bytes [start, stop), fall into: equal windows come under one key."""
    more = (LENGTH - (stop - start) + 1) // 2
    left = min(max(start - more + 1, 0), n)  # windows that begin at least ``more`` bytes before ``start``
    out = []
    for side, (lo, hi, a, b) in enumerate(((0, left, start - more, stop), (left, n, start, stop + more))):
        if lo < hi:
            out.append((lo, hi - lo, xxh64_intdigest(part[a:b], 2 * (b - a) + side), a, b))
    return out


def _narrow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The windows of segments of hot keys under narrower ones, as segments. ``start`` and ``stop`` bound the bytes
    that all windows of the key hold; without them they are the anchor's, the first string of its hash."""
    columns = ["h", "part", "id", "th", "lo", "n", "start", "stop"]
    for batch in batches:
        rows = []
        for h, part, id_, th, lo, n, start, stop in batch[columns].itertuples(index=False):
            if start < 0:
                start = int(np.flatnonzero(gram_hashes(np.frombuffer(part, np.uint8)).view(np.int64) == h)[0])
                stop = start + GRAM
            for first, count, key, a, b in narrowed(part, n, start, stop):
                key -= key >> 63 << 64
                rows.append((key, part[first : first + count + LENGTH - 1], id_, th, lo + first, count, a - first, b - first))
        yield pd.DataFrame(rows, columns=columns)


def _spread(parts: DataFrame, hot: DataFrame) -> DataFrame:
    """``parts`` with the windows of keys that have more than ``HOT`` segments with bytes under narrower keys."""
    schema = "h long, part binary, id long, th long, lo long, n long, start int, stop int"
    parts = written(parts, "parts")
    told = parts.join(hot, "h", "left_semi").where("part is not null")
    many = told.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > HOT).select("h")
    settled, left = None, parts.withColumns({"start": F.lit(-1), "stop": F.lit(-1)})
    while True:
        many = written(many, "many")
        hot_rows = (F.col("part").isNotNull()) & (F.col("stop") - F.col("start") < LENGTH)
        done = left.where(~hot_rows).unionByName(left.where(hot_rows).join(many, "h", "left_anti")).select(*parts.columns)
        settled = done if settled is None else settled.unionByName(done)
        left = left.where(hot_rows).join(many, "h", "left_semi")
        if many.isEmpty() or left.isEmpty():
            return settled
        left = written(left.select("h", "part", "id", "th", "lo", "n", "start", "stop").mapInPandas(_narrow, schema), "narrow")
        many = left.groupBy("h").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") > HOT).select("h")


def repeated_windows(parts: list[bytes], rank: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each of the distinct ``parts`` which of its windows also start earlier, where a window's
    start is ``rank`` of its part (a row of numbers compared from the first) plus its place."""
    sizes = np.array([len(p) for p in parts], np.int64)
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int32)
    text += np.int32(len(parts))
    ends = np.cumsum(sizes + 1) - 1
    text[ends] = np.arange(len(parts))[::-1]
    places, common = suffix_order(text, len(parts) + 256)
    # Suffixes that share ``length`` bytes with a neighbour; they hold a window, as no end symbol is shared.
    near = common >= length
    shared = np.flatnonzero(near | np.append(near[1:], False))
    cluster, places = np.cumsum(~near[shared]), places[shared]
    part = np.searchsorted(ends, places)
    offset = places - (ends - sizes)[part]
    order = np.lexsort((rank[part, 2] + offset, rank[part, 1], rank[part, 0], cluster))
    part, offset, cluster = part[order], offset[order], cluster[order]
    again = np.concatenate(([False], cluster[1:] == cluster[:-1]))[: len(cluster)]  # none where no window is shared
    stops = np.cumsum(sizes - length + 1)
    flags = np.zeros(stops[-1], bool)
    flags[(stops - sizes + length - 1)[part[again]] + offset[again]] = True
    return np.split(flags, stops[:-1])


def _flagged_runs(flags: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, past the last) of the runs of true flags in every row of ``flags``."""
    sizes = np.array([len(x) + 1 for x in flags], np.int64)
    padded = np.zeros(sizes.sum() + 1, np.int8)  # a false flag ahead of each row and one at the end
    padded[np.delete(np.arange(1, len(padded)), np.cumsum(sizes) - 1)] = np.concatenate(flags)
    change = np.diff(padded)
    starts, stops = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    opens = np.cumsum(sizes) - sizes
    row = np.searchsorted(opens, starts, side="right") - 1
    return row, starts - opens[row], stops - opens[row]


def _shard_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs [a, b) of window starts that also start earlier."""
    for shard in whole_groups(batches, ["shard"]):
        shard = shard.iloc[np.lexsort((shard["lo"].to_numpy(), shard["th"].to_numpy(), shard["id"].to_numpy()))]
        places = shard[["id", "th", "lo"]].to_numpy()
        with_bytes = np.flatnonzero(shard["part"].notna().to_numpy())
        first = np.zeros(len(shard), bool)
        first[with_bytes] = ~shard["part"].iloc[with_bytes].duplicated().to_numpy()
        # A copy of the same place (a repeated row) is not an earlier one.
        place = np.cumsum(np.concatenate(([True], (places[1:] != places[:-1]).any(axis=1)))) - 1
        own = np.zeros(len(shard), bool)
        own[place[first]] = True
        copies, kept, ranks = shard[~first & ~own[place]], shard[first], places[first]
        yield pd.DataFrame({"id": copies["id"], "th": copies["th"], "a": copies["lo"], "b": copies["lo"] + copies["n"]})
        shared = kept["h"].duplicated(keep=False).to_numpy()
        if shared.any():
            ranks = ranks[shared]
            row, a, b = _flagged_runs(repeated_windows(kept["part"][shared].tolist(), ranks))
            yield pd.DataFrame({"id": ranks[row, 0], "th": ranks[row, 1], "a": ranks[row, 2] + a, "b": ranks[row, 2] + b})


def _merged(runs, length: int) -> list[dict]:
    """Removed byte spans, apart and in order, from runs of window starts."""
    out: list[dict] = []
    for a, b in sorted((x["a"], x["b"]) for x in runs):
        b += length - 1
        if out and a <= out[-1]["stop"]:
            out[-1]["stop"] = max(out[-1]["stop"], b)
        else:
            out.append({"start": a, "stop": b})
    return out


def _written_small(df: DataFrame, array: str, item_bytes: int) -> DataFrame:
    """``df`` (id, th and an array) written once; to be broadcast if the written rows are counted to fit
    ``BROADCAST_BYTES``, joined by a shuffle of both sides if not."""
    df = written(df, array)
    rows, items = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size(array)), F.lit(0))).first()
    return F.broadcast(df) if 64 * rows + item_bytes * items <= BROADCAST_BYTES else df


def remaining(text: Column, spans: Column) -> Column:
    """The bytes of ``text`` outside ``spans`` (binary)."""

    @F.pandas_udf("binary")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        out = []
        for text, spans in zip(texts, lists):
            raw = b"" if text is None else text.encode("utf-8", "replace")
            edges = [0, *(x for s in spans for x in (s["start"], s["stop"])), len(raw)]
            out.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2])]))
        return pd.Series(out, dtype=object)

    return cut(text, spans)


def repeated_spans(docs: DataFrame, id: str = "doc_id", text: str = "text", spans: str = "spans") -> DataFrame:
    """``docs`` with the column named ``spans``, an array of (start, stop) byte spans that also start earlier."""
    bound_batches(docs.sparkSession)
    key = F.coalesce(docs[id].cast("long"), F.lit(-(1 << 63))).alias("id")
    whole = F.coalesce(docs[text], F.lit("")).alias("text")
    rows = docs.select(key, F.xxhash64(docs[text]).alias("th"), whole)
    long_enough = rows.where(F.octet_length("text") >= LENGTH)
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    anchors = long_enough.mapInPandas(_anchor_rows, "deal long, seen long, id long, th long, lo long")
    again = anchors.repartition("deal").sortWithinPartitions("deal").mapInPandas(_repeating, "id long, th long, lo int")
    found = _written_small(again.groupBy("id", "th").agg(F.collect_list("lo").alias("found")), "found", 4)
    hot = found.where("id is null").select(F.col("th").alias("h"))
    parts = long_enough.join(found, ["id", "th"]).mapInPandas(_cut_segments, "h long, part binary, id long, th long, lo long, n long")
    if not hot.isEmpty():
        parts = _spread(parts, written(hot, "hot"))
    # Copies without bytes are repeats already; they are spread by their place.
    deal = F.when(F.col("part").isNull(), F.xxhash64("id", "lo")).otherwise(F.xxhash64("h"))
    dealt = parts.withColumn("shard", F.pmod(deal, F.lit(shards))).repartition(int(min(shards, 100_000)), "shard")
    runs = dealt.sortWithinPartitions("shard").mapInPandas(_shard_spans, "id long, th long, a long, b long")

    @F.pandas_udf("array<struct<start:long,stop:long>>")
    def merged(lists: pd.Series) -> pd.Series:
        return pd.Series([_merged(runs, LENGTH) for runs in lists], dtype=object)

    own_id, own_hash, found_spans = (free_name(docs, x) for x in ("own_id", "own_hash", "found_spans"))
    per_doc = runs.groupBy("id", "th").agg(F.collect_list(F.struct("a", "b")).alias("runs"))
    per_doc = _written_small(per_doc.select("id", "th", merged("runs").alias("spans")), "spans", 32).select(F.col("id").alias(own_id), F.col("th").alias(own_hash), F.col("spans").alias(found_spans))
    same = (key == F.col(own_id)) & (F.xxhash64(docs[text]) == F.col(own_hash))
    none = F.array().cast("array<struct<start:long,stop:long>>")
    return docs.join(per_doc, same, "left").withColumn(spans, F.coalesce(found_spans, none)).drop(own_id, own_hash, found_spans)


def remaining_text(text: Column, spans: Column) -> Column:
    """``remaining`` as text; a character of which only some bytes are left goes."""

    @F.pandas_udf("string")
    def decoded(kept: pd.Series) -> pd.Series:
        return kept.map(lambda b: bytes(b).decode("utf-8", "ignore")).astype(object)

    return decoded(remaining(text, spans))
