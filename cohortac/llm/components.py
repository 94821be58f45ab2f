"""Connected components of a distributed edge list, and merging links inside a task."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.llm.shared import written


HUBS = 256
FEW = 64


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("decimal(38,0)"))).first())


def _with_least(edges: DataFrame, least: Column, n: int) -> DataFrame:
    """``edges`` (at most 2 ``n``) with m, ``least`` of all edges of their a.

    Nodes with over one in ``HUBS`` of the edges are few whatever the input, at most ``2 * HUBS``;
    their m is broadcast, and only the edges of the others move to their node.
    """
    found = edges.groupBy("a").agg(least.alias("m"), F.count(F.lit(1)).alias("degree"))
    found = written(found, "least")
    hubs = F.col("degree") > max(FEW, n // HUBS)
    at_hubs = edges.join(F.broadcast(found.where(hubs).select("a", F.col("m").alias("hub_m"))), "a", "left")
    others = found.where(~hubs).select("a", "m")
    there = at_hubs.where("hub_m IS NOT NULL").select("a", "b", F.col("hub_m").alias("m"))
    return there.unionByName(at_hubs.where("hub_m IS NULL").select("a", "b").join(others, "a"))


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that is not the smallest
    of its component.

    ``edges`` has columns a and b (long, not null). Alternating large-star and small-star
    rounds until nothing changes; edges and labels stay distributed and every round is written to
    the shared folder. A node with very many neighbours is one key of a minimum, which is taken
    before the shuffle, and its own minimum comes to its edges instead of the other way
    (``_with_least``), so no task holds a large component. Repeated links, links of a node to
    itself and an empty table are allowed.
    """
    edges = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        met = _with_least(both, F.least("a", F.min("b")), state[0]).where("b > a")
        large = written(met.select(F.col("b").alias("a"), F.col("m").alias("b")), "large")
        small = _with_least(large, F.min("b"), state[0]).select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = written(small.select(F.col("e.a"), F.col("e.m").alias("b")).where("a <> b").distinct(), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


class Forest:
    """Sets of rows 0..n-1 merged by links; the least row stands for its set."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        root = self.root
        while len(a):
            a, b = root[a], root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:  # every row points at a root again
                up = root[root]
                if (up == root).all():
                    break
                root[:] = up

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, root) of the rows that are not roots."""
        rows = np.flatnonzero(self.root != np.arange(len(self.root)))
        return rows, self.root[rows]
