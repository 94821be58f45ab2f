"""Exact top-k inner-product search over an impact-ordered index.

Rows are dealt into shards and queries into blocks; each task has one shard and one block, so
neither side is held whole anywhere. A shard's index has, for every dimension, postings
segments of rows whose value lies in one quantised level. A query takes the segments of all
dimensions in descending order of impact (what they add to a score above the least of their
dimension), a run of them at a time. Two bounds hold for every row: its dimensions that are still
to come add at most the next impact each, and quantising moved its score by at most the query's length
times the length of what the row lost by it. So the rows that could be among the best ``k`` are
known at any time: those whose upper bound reaches the least full score of the ``k`` rows that are
ahead. The search stops early only when few such rows are left, which is a proof that no other row
belongs; they are scored exactly. Without such a proof it goes through all segments and scores every possible member
exactly, however many.

Defined results: vectors that are null or hold null or non-finite components take no part,
neither do rows without an id; only vectors of a query's length are its candidates; rows with
the query's id are its own and are left out; equal scores rank by smaller id; repeated rows
are candidates one by one, and repeated queries (same id and vector) are answered once; a query with
fewer than ``k`` candidates gets them all; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD_ROWS = 16_384
QUERY_ROWS = 2048
LEVEL = 4
RUNS = 32
RESCORE = 50
FEWEST = 64


class ImpactIndex:
    """Postings segments of integer vectors by dimension and quantised value, as one list of rows.
    A segment stands for its rows' values by its middle; ``off`` is the length of what each row
    differs from its middles by."""

    def __init__(self, values: np.ndarray, level: int = LEVEL):
        self.values = values
        n, n_dims = values.shape
        order = np.argsort(values, axis=0, kind="stable")
        ascending = np.take_along_axis(values, order, axis=0).T
        self.rows = order.T.ravel()
        opens = np.ones(ascending.shape, bool)
        opens[:, 1:] = np.diff(ascending // level, axis=1) != 0
        self.starts = np.flatnonzero(opens)
        self.sizes = np.diff(np.append(self.starts, n * n_dims))
        self.dims = self.starts // max(n, 1)
        flat = ascending.ravel().astype(np.float64)
        self.middle = (flat[self.starts] + flat[self.starts + self.sizes - 1]) / 2
        apart = flat - np.repeat(self.middle, self.sizes)
        self.off = np.sqrt(np.bincount(self.rows, apart * apart, n))
        self.first = np.searchsorted(self.dims, np.arange(n_dims))
        self.read = 0.0  # share of the postings that the last search read

    def possible(self, query: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """Rows that can be among the ``k`` best of ``query``; ``own`` rows are left out."""
        n, n_dims = self.values.shape
        if n - len(own) <= k or not n_dims:
            return np.setdiff1d(np.arange(n), own)
        q = query.astype(np.float64)
        value = q[self.dims] * self.middle
        base = np.minimum.reduceat(value, self.first)
        impact = value - base[self.dims]  # nothing a segment adds is negative
        order = np.argsort(-impact, kind="stable")
        ends = np.cumsum(self.sizes[order])
        runs = np.unique(np.append(np.searchsorted(ends, np.arange(1, RUNS) * (ends[-1] / RUNS)) + 1, len(order)))
        # A row's score is its segments' values and at most this much more or less (with what rounding may add).
        slack = 1e-12 * np.maximum.reduceat(np.abs(value), self.first).sum()
        off = np.linalg.norm(q) * self.off + slack
        sums, left, begun = np.zeros(n), np.full(n, n_dims), 0
        few = max(FEWEST, n // RESCORE)
        for end in runs.tolist():
            run = order[begun:end]
            sizes = self.sizes[run]
            places = np.arange(sizes.sum()) + np.repeat(self.starts[run] - np.cumsum(sizes) + sizes, sizes)
            rows = self.rows[places]
            sums += np.bincount(rows, np.repeat(impact[run], sizes), n)
            left -= np.bincount(rows, minlength=n)
            # A row's dimensions that are still to come add at most the next impact each.
            next_impact = impact[order[end]] if end < len(order) else 0.0
            least, most = sums - off, sums + left * next_impact + off
            least[own] = most[own] = -np.inf
            # The k rows that are ahead, scored in full, bound the k-th best from below.
            ahead = np.argpartition(least, n - k)[n - k :]
            members = np.flatnonzero(most >= (self.values[ahead] @ q).min() - base.sum() - slack)
            begun = end
            if len(members) <= few:
                break
        self.read = float(ends[begun - 1] / ends[-1])
        return members


def search_cell(rows: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best of this shard for each query of this block: qid, query, vec_id, score."""
    columns = ["qid", "query", "vec_id", "score"]
    if not len(rows) or not len(queries):
        return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
    ids, values = rows["id"].to_numpy(), np.array(rows["vec"].tolist(), np.int64)
    index, found = ImpactIndex(values), []
    places = pd.Series(np.arange(len(ids))).groupby(ids).indices
    for qid, own, vec in zip(queries["qid"], queries["id"], queries["vec"]):
        query = np.asarray(vec, np.int64)
        members = index.possible(query, k, places.get(own, np.zeros(0, np.int64)))
        scores = values[members] @ query
        best = np.lexsort((ids[members], -scores))[:k]
        found.append(pd.DataFrame({"qid": qid, "query": own, "vec_id": ids[members[best]], "score": scores[best]}))
    return pd.concat(found, ignore_index=True)


def quantised(vectors: DataFrame, id: str = "vec_id", vec: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, vec): components floor(scale * x) as integers; unusable vectors are left out."""
    wide = F.transform(vectors[vec], lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.coalesce(finite, F.lit(False)) & vectors[id].isNotNull()).select(
        vectors[id].cast("long").alias("id"), F.transform(wide, lambda x: F.floor(x * scale)).alias("vec")
    )


def top_k(rows: DataFrame, queries: DataFrame, k: int, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best of ``rows`` for each of ``queries`` (both:
    id, vec array<long>)."""
    queries = queries.select("id", "vec", F.xxhash64("id", "vec").alias("qid")).dropDuplicates(["qid"])
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_rows))

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def dealt(c, n: int):
        return F.pmod(c, F.lit(n)).cast("int")

    rows = rows.withColumn("shard", dealt(F.xxhash64("id"), shards)).withColumn("block", every(blocks))
    queries = queries.withColumn("block", dealt(F.col("qid"), blocks)).withColumn("shard", every(shards))
    cells = [x.withColumn("dims", F.size("vec")).groupBy("shard", "block", "dims") for x in (rows, queries)]
    found = cells[0].cogroup(cells[1]).applyInPandas(lambda a, b: search_cell(a, b, k), "qid long, query long, vec_id long, score long")
    place = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")
