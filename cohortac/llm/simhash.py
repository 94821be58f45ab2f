"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: the majority, bit by bit, of the hashes of a text's word shingles. Documents
link when their fingerprints differ in at most ``radius`` bits, and a component is a class.

Equal fingerprints are one class from the start, so only distinct ones are compared. The 64
bits are cut into ``radius + 2`` blocks; two fingerprints within the radius agree in at least
two of the blocks whole, so each goes to one bucket for every pair of blocks, and only
fingerprints of a bucket are compared. A bucket of more than ``CHUNK`` is dealt into chunks by
a hash of the fingerprint and every pair of chunks becomes a bucket, so no task has to hold a
hot bucket and none of its pairs is lost.

Inside a task the fingerprints are stored vertically, one bit plane per fingerprint bit with
a lane per row. Comparing every row with the one ``s`` places on is a shift and an exclusive
or of the planes; the differing bits are added to all lanes at once in carry-save counters
(ones, twos, overflow), and a block of lanes is abandoned as soon as all lanes exceed the
radius. Links become a spanning forest per bucket, so what leaves a task is linear in its
rows.

Defined results: a text without words (null, empty, only white space) has fingerprint zero
and links like any other; a very long text is read whole; repeated rows fall in one class; rows
that share an id are linked by their texts alone; rows without an id get a fingerprint but take no
part in the links (component null); an empty table gives no rows. Columns beside the id, the text
and ``keep`` are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType
from xxhash import xxh64_intdigest

from cohortac.llm.components import Forest, components
from cohortac.llm.shared import written

CHUNK = 2048
SEED = 42


def fingerprint_of(text: str | None, words: int) -> int:
    """The fingerprint, as a signed 64-bit number. Words are what white space (0x20, 0x09-0x0D)
    leaves of the text with A-Z lower-cased."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    if len(found) <= words:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate(([0], ends[: len(found) - words] + 1))
        spans = zip(starts.tolist(), ends[words - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column, words: int = 3) -> Column:
    @F.pandas_udf(LongType())
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return of(text)


def bucket_keys(fp: Column, radius: int) -> Column:
    """Array of the buckets of a fingerprint: one number per pair of blocks."""
    n = radius + 2
    edges = [64 * k // n for k in range(n + 1)]
    block = [F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]
    return F.array(
        *(
            F.shiftleft(F.shiftleft(block[i], 16).bitwiseOR(block[j]), 8).bitwiseOR(F.lit(k))
            for k, (i, j) in enumerate(combinations(range(n), 2))
        )
    )


def close_pairs(fps: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group whose fingerprints differ in at most ``radius`` bits.

    Rows of a group must be adjacent. Every round compares all rows with the row ``s`` on.
    """
    rows, s = np.arange(len(fps)), 1
    while True:
        # Only groups of more than s rows are left; others have been compared whole.
        _, at, sizes = np.unique(group[rows], return_inverse=True, return_counts=True)
        rows = rows[sizes[at] > s]
        if not len(rows):
            return
        largest_kept = max(2 * s, 64)
        planes = _planes(fps[rows])
        ids = group[rows]
        while s < largest_kept and s < len(rows):
            near = np.zeros(len(rows), bool)
            same = ids[s:] == ids[:-s]
            if not same.any():
                return
            near[: len(same)] = same
            near = _within(planes, s, near, radius)
            left = np.flatnonzero(near)
            if len(left):
                yield rows[left], rows[left + s]
            s += 1


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of every fingerprint, 64 lanes to a word."""
    lanes = -len(fps) % 64
    bits = np.unpackbits(np.append(fps, np.zeros(lanes, fps.dtype)).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")


def _within(planes: np.ndarray, s: int, lanes: np.ndarray, radius: int) -> np.ndarray:
    """Which of ``lanes`` differ from the lane ``s`` on in at most ``radius`` bits."""
    over = ~_packed(lanes)  # lanes that need no more counting
    live = np.flatnonzero(~over)  # words that have a lane to count
    words, bits = divmod(s, 64)
    padded = np.concatenate([planes, np.zeros((64, words + 2), planes.dtype)], axis=1)
    over = over[live]
    counters = [np.zeros(len(live), np.uint64) for _ in range(radius.bit_length())]
    past = np.uint64(64 - bits)
    for k, plane in enumerate(padded):
        other = plane[live + words]
        if bits:
            other = (other >> np.uint64(bits)) | (plane[live + words + 1] << past)
        carry = plane[live] ^ other
        for i, counter in enumerate(counters):
            counters[i], carry = counter ^ carry, counter & carry
        over |= carry
        if radius + 1 < 1 << radius.bit_length():  # counts in the counters' range but past the radius
            over |= _above(counters, radius)
        if k % 8 == 7:
            open_ = ~over != 0
            if not open_.all():  # blocks in which every lane exceeds the radius are abandoned
                live, over, counters = live[open_], over[open_], [c[open_] for c in counters]
                if not len(live):
                    break
    out = np.zeros(planes.shape[1], np.uint64)
    out[live] = ~over
    return np.unpackbits(out.astype("<u8").view(np.uint8), bitorder="little")[: len(lanes)].astype(bool) & lanes


def _above(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose count is more than ``radius``."""
    above, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for i in range(len(counters) - 1, -1, -1):
        if radius >> i & 1:
            equal &= counters[i]
        else:
            above |= equal & counters[i]
            equal &= ~counters[i]
    return above


def _packed(lanes: np.ndarray) -> np.ndarray:
    lanes = np.append(lanes, np.zeros(-len(lanes) % 64, bool))
    return np.packbits(lanes, bitorder="little").view("<u8")


def whole_groups(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The batches, with rows sorted by ``key``, cut anew so that no group spans two."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = np.zeros(len(batch), bool)
        for k in key:
            v = batch[k].to_numpy()
            change[1:] |= v[1:] != v[:-1]
        if held and any(held[-1][k].iloc[-1] != batch[k].iloc[0] for k in key):
            yield pd.concat(held, ignore_index=True)
            held = []
        cuts = np.flatnonzero(change)
        if len(cuts):
            yield pd.concat([*held, batch.iloc[: cuts[-1]]], ignore_index=True)
            held = [batch.iloc[cuts[-1] :]]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)


def links(classes: DataFrame, radius: int, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) between class ids that connect exactly the fingerprints within ``radius`` of
    each other. ``classes``: fp (distinct), node."""
    keyed = classes.select("fp", "node", F.explode(bucket_keys(F.col("fp"), radius)).alias("bucket"))
    hot = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chunk)
    chunks = F.coalesce(F.ceil(F.col("n") / chunk), F.lit(1)).cast("int")
    dealt = keyed.join(hot, "bucket", "left").withColumn("chunks", chunks).drop("n")
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = dealt.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    cells = cells.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "fp", "node")
    key = ["bucket", "i", "j"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in whole_groups(batches, key):
            group = np.cumsum(np.concatenate([[False], (rows[key].to_numpy()[1:] != rows[key].to_numpy()[:-1]).any(axis=1)]))
            forest = Forest(len(rows))
            for a, b in close_pairs(rows["fp"].to_numpy().view(np.uint64), group, radius):
                forest.link(a, b)
            child, root = forest.edges()
            node = rows["node"].to_numpy()
            yield pd.DataFrame({"a": node[child], "b": node[root]})

    return cells.repartition(*key).sortWithinPartitions(*key).mapInPandas(compare, "a long, b long")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, radius: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, fp (signed 64-bit fingerprint), component_id (smallest id
    reachable by links, itself included), fp_group (smallest fingerprint of the component; rows that
    share an id but not the component are told apart by it) and the columns ``keep``."""
    prints = written(docs.select(docs[id].cast("long").alias("id"), fingerprint(docs[text], words).alias("fp"), *keep), "fingerprints")
    classes = written(prints.where("id is not null").groupBy("fp").agg(F.min("id").alias("least")), "classes")
    found = components(links(classes.select("fp", F.col("fp").alias("node")), radius))
    labels = classes.join(found, classes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("fp_group"))
    least = labels.groupBy("fp_group").agg(F.min("least").alias("component_id"))
    named = labels.join(least, "fp_group").select("fp", "fp_group", "component_id")
    has_id = F.col("id").isNotNull()
    return prints.join(named, "fp", "left").select(
        F.col("id").alias(id), "fp", *[F.when(has_id, F.col(c)).alias(c) for c in ("component_id", "fp_group")], *keep
    )


def as_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
