"""Stupid-backoff language-model scores, computed with joins and sums.

Every document is scored by the corpus without itself: c'(gram) is the number of times all other
documents have an n-gram. The score of a word after its history is c'(n-gram) / c'(its first n - 1 words)
for the longest n-gram of up to ``order`` words with c' > 0, times ``backoff`` for every order given up; one-word
frequencies are c'(word) / (all words of the others), at least one word each. A document's score is the sum of the
logarithms over its words.

Documents are written as chunks of about ``chunk_bytes`` of text. A chunk's different n-grams of all orders, each once with
its number in the chunk, go to their bucket: a range of keys, as a sorted block for each chunk and bucket. A bucket sums an
n-gram's numbers over its blocks and answers every block with how often all other chunks have each of its n-grams, in the
block's order, so keys do not travel back. Chunks meet their answers again, and c' is the answer and the chunk's number without
the document's own. All n-grams are counted; one that every document has is one entry for each chunk.

The keys are by far the most of what moves. They are counted in ``passes`` ranges, one after the other, and Spark
removes a range's shuffle files when its answers are written: 1 / ``passes`` of the keys is on disk at a time. For that
every pass reads and hashes the texts again. Buckets grow in number with the words, not in size.

N-grams are keyed by 64-bit hashes of their words' hashes. Words are what white space (0x20, 0x09-0x0D) leaves of the
lower-cased text. Defined results: a text without words (null, empty) has 0 words and score null; a very long
text is scored whole, in a chunk of its own; every row is a document of its own for c', and rows that repeat an id are summed together,
as are rows without an id; an empty table gives no rows. Columns beside id and text are not read, whatever their
names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.llm.shared import bound_batches, shuffle_files_removed, written

ORDER = 3
BACKOFF = 0.4
PASSES = 4
CHUNK_BYTES = 1 << 22
BUCKET_KEYS = 1 << 22  # n-grams of a bucket, repeats in a chunk included
BUCKETS_PER_CORE = 4  # and at least, in a pass
ROW_GROUP = 1 << 24  # a reader holds the rows of one at a time, and a row is a chunk

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTERS = np.frombuffer(hashlib.shake_256(b"letters").digest(8 * 256), np.uint64) * ~SPACE  # white space weighs nothing
BASE = 0x9E3779B97F4A7C15
SLICE = 1 << 16


@lru_cache(4)
def _powers(size: int, base: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


def _starts(data: np.ndarray) -> np.ndarray:
    """Where words start; ``data`` begins with white space."""
    space = SPACE[data]
    return np.flatnonzero(space[:-1] & ~space[1:]) + 1


def _joined(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with white space before each, and where each of them ends."""
    data = np.frombuffer(b"".join(b" " + (t or b"") for t in texts), np.uint8)
    return data, np.cumsum([1 + len(t or b"") for t in texts])


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the number of each one's text.

    A word's hash is the sum of its bytes' random numbers, each times a power of an odd base by its place in the word
    (here by its place in a slice of the texts, and the power of the word's start taken out), mixed."""
    data, ends = _joined(texts)
    starts = _starts(data)
    h = np.zeros(len(starts), np.uint64)
    first = np.unique(np.searchsorted(starts, np.arange(0, len(data), SLICE)))
    stops = np.append(starts, len(data))
    for i, j in zip(first, np.append(first[1:], len(starts))):
        if i == j:
            continue
        a, b, at = stops[i], stops[j], starts[i:j] - stops[i]
        size = max(2 * SLICE, 1 << int(b - a).bit_length())
        h[i:j] = np.add.reduceat(LETTERS[data[a:b]] * _powers(size, BASE)[: b - a], at) * _powers(size, pow(BASE, -1, 1 << 64))[at]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32)), np.searchsorted(ends, starts, side="right")


def gram_keys(w: np.ndarray, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that start at every place, for n = 1 to ``order``: of the first n - 1 words and the last n - 1."""
    keys = [w.astype(np.uint64)]
    for n in range(2, order + 1):
        head, tail = keys[-1][:-1], keys[-1][1:]
        x = head * np.uint64(0x9E3779B97F4A7C15) + ((tail << np.uint64(31)) | (tail >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(n)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        keys.append(x ^ (x >> np.uint64(32)))
    return keys


def chunk_grams(texts: list[bytes | None], order: int) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Every word's text; for each n the places where n-grams within a text start, and their keys."""
    w, doc = word_hashes(texts)
    places, keys = [], []
    for n, k in enumerate(gram_keys(w, order)):
        inside = np.flatnonzero(doc[: len(k)] == doc[n : n + len(k)])
        places.append(inside)
        keys.append(k[inside])
    return doc, places, keys


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of every key; it rises with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def packed(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each; those from 255 on follow as whole numbers."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[counts >= 255].astype(np.int64).tobytes()


def unpacked(small: bytes, large: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(large, np.int64)
    return counts


def chunked(docs: DataFrame, id_type: str, chunk_bytes: int) -> DataFrame:
    """(chunk, n_words, ids, texts) of (id, text): a row for every ``chunk_bytes`` of text."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, held, size, n = TaskContext.get().partitionId() << 33, [], 0, 0

        def row() -> pa.RecordBatch:
            ids, texts = (pa.chunked_array([b.column(k) for b in held]).combine_chunks() for k in ("id", "text"))
            n_words = len(_starts(_joined(texts.to_pylist())[0]))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (ids, texts)]
            return pa.RecordBatch.from_arrays([pa.array([first + n]), pa.array([n_words]), *lists], names=["chunk", "n_words", "ids", "texts"])

        for batch in batches:
            at, before = 0, np.cumsum([0, *(x or 0 for x in batch.column("n").to_pylist())])
            while at < len(batch):
                end = int(np.searchsorted(before, before[at] + chunk_bytes - size, side="left"))
                end = min(max(end, at + 1), len(batch))
                held.append(batch.slice(at, end - at))
                size += int(before[end] - before[at])
                at = end
                if size >= chunk_bytes:
                    yield row()
                    held, size, n = [], 0, n + 1
        if held:
            yield row()

    rows = docs.select("id", F.lower("text").cast("binary").alias("text"))
    rows = rows.withColumn("n", F.octet_length("text") + F.lit(1))
    return rows.mapInArrow(assemble, f"chunk long, n_words long, ids array<{id_type}>, texts array<binary>")


def blocks(chunks: DataFrame, order: int, buckets: int, first: int, last: int) -> DataFrame:
    """(bucket, chunk, g, small, large): the chunks' different n-grams in buckets ``first`` to ``last`` - 1, in rising order of
    keys, with their number there."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, texts in zip(batch.column("chunk").to_pylist(), batch.column("texts")):
                keys = np.concatenate(chunk_grams(texts.as_py(), order)[2])
                bucket = bucket_of(keys, buckets)
                g, f = np.unique(keys[(bucket >= first) & (bucket < last)], return_counts=True)
                ends = np.searchsorted(bucket_of(g, buckets), np.arange(first, last + 1))
                rows = [(b, chunk, g[i:j].tobytes(), *packed(f[i:j])) for b, i, j in zip(range(first, last), ends[:-1], ends[1:]) if i < j]
                if rows:
                    columns = (pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())))
                    yield pa.RecordBatch.from_arrays(list(columns), names=["bucket", "chunk", "g", "small", "large"])

    return chunks.select("chunk", "texts").mapInArrow(explode, "bucket long, chunk long, g binary, small binary, large binary")


def elsewhere(blocks: DataFrame) -> DataFrame:
    """(chunk, bucket, small, large): how often all other chunks have the n-grams of a block, in its order; no row where none has any."""

    def count(table: pa.Table) -> pa.Table:
        g = [np.frombuffer(x, np.uint64) for x in table["g"].to_pylist()]
        ends = np.cumsum([len(x) for x in g])[:-1]
        g, f = np.concatenate(g), np.concatenate([unpacked(*x) for x in zip(table["small"].to_pylist(), table["large"].to_pylist())])
        at = np.argsort(g)
        g, f = g[at], f[at]
        firsts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
        others = np.empty(len(g), np.int64)
        others[at] = np.repeat(np.add.reduceat(f, firsts), np.diff(np.append(firsts, len(g)))) - f
        found = [(chunk, bucket, *packed(c)) for chunk, bucket, c in zip(table["chunk"].to_pylist(), table["bucket"].to_pylist(), np.split(others, ends)) if c.any()]
        columns = zip(*found) if found else ((),) * 4
        types = (pa.int64(), pa.int64(), pa.binary(), pa.binary())
        return pa.table([pa.array(x, t) for x, t in zip(columns, types)], names=["chunk", "bucket", "small", "large"])

    return blocks.groupBy("bucket").applyInArrow(count, "chunk long, bucket long, small binary, large binary")


def other_counts(keys: np.ndarray, doc: np.ndarray, buckets: int, found: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """c' of a chunk's n-grams: of the other chunks and of the chunk, without their own document's. Equal keys come by rising document."""
    at = np.argsort(keys, kind="stable")
    g, d = keys[at], doc[at]
    new = np.append(True, g[1:] != g[:-1])
    firsts, own = np.flatnonzero(new), np.flatnonzero(new | np.append(True, d[1:] != d[:-1]))
    sizes, own_sizes = np.diff(np.append(firsts, len(g))), np.diff(np.append(own, len(g)))
    total = sizes.copy()
    bucket = bucket_of(g[firsts], buckets)
    for b, small, large in found:
        i, j = np.searchsorted(bucket, [b, b + 1])
        total[i:j] += unpacked(small, large)
    c = np.empty(len(g), np.int64)
    c[at] = np.repeat(total, sizes) - np.repeat(own_sizes, own_sizes)
    return c


def chunk_scores(texts: list[bytes | None], found: list[tuple[int, bytes, bytes]], buckets: int, total: int, order: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
    """Every text's number of words, and its sum of the logarithms over them."""
    doc, places, keys = chunk_grams(texts, order)
    n_words = np.bincount(doc, minlength=len(texts))
    if not len(doc):
        return n_words, np.zeros(len(texts))
    c = other_counts(np.concatenate(keys), np.concatenate([doc[p] for p in places]), buckets, found)
    c = np.split(c, np.cumsum([len(p) for p in places])[:-1])
    score = np.log(np.maximum(c[0], 1) / np.maximum(total - n_words[doc], 1))
    heads = c[0]
    for n in range(2, order + 1):
        at, counts = places[n - 1], c[n - 1]
        with np.errstate(divide="ignore", invalid="ignore"):
            score[at + n - 1] = np.where(counts > 0, np.log(counts / heads[at]), score[at + n - 1] + math.log(backoff))
        heads = np.zeros(len(doc), np.int64)
        heads[at] = counts
    return n_words, np.bincount(doc, weights=score, minlength=len(texts))


def scores(
    docs: DataFrame, id: str = "doc_id", text: str = "text", order: int = ORDER, backoff: float = BACKOFF, passes: int = PASSES, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """id, n_words, score (sum of natural logarithms; null without words)."""
    spark = docs.sparkSession
    bound_batches(spark)
    id_type = docs.schema[id].dataType.simpleString()
    chunks = chunked(docs.select(docs[id].alias("id"), docs[text].alias("text")), id_type, chunk_bytes)
    chunks = written(chunks, "chunks", **{"compression": "zstd", "parquet.block.size": ROW_GROUP})
    total, n_chunks = chunks.agg(F.coalesce(F.sum("n_words"), F.lit(0)), F.count(F.lit(1))).first()
    cores = spark.sparkContext.defaultParallelism
    each = max(BUCKETS_PER_CORE * cores, -(-total * order // (passes * BUCKET_KEYS)))
    buckets = passes * each
    found = []
    for first in range(0, buckets, each):
        with shuffle_files_removed(spark):
            found.append(written(elsewhere(blocks(chunks, order, buckets, first, first + each)), "counts", compression="zstd"))

    def score(chunk: pa.Table, counts: pa.Table) -> pa.Table:
        counts = list(zip(*(counts[k].to_pylist() for k in ("bucket", "small", "large"))))
        ids, texts = (chunk[k].combine_chunks().flatten() for k in ("ids", "texts"))
        n, s = chunk_scores(texts.to_pylist(), counts, buckets, total, order, backoff)
        return pa.table([ids, pa.array(n, pa.int64()), pa.array(s, pa.float64(), mask=n == 0)], names=["id", "n_words", "score"])

    tasks = max(min(cores, n_chunks), n_chunks // 2, 1)
    answers = reduce(DataFrame.unionByName, found).repartition(tasks, "chunk")
    both = chunks.select("chunk", "ids", "texts").repartition(tasks, "chunk").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    scored = both.applyInArrow(score, f"id {id_type}, n_words long, score double")
    summed = scored.groupBy("id").agg(F.sum("n_words").alias("n_words"), F.sum("score").alias("score"))
    return summed.withColumnRenamed("id", id)
