"""Embedding whitening by polarisation: covariances from variances alone.

Entries become whole numbers x = floor(scale * c) + offset, and y = n * x - S (n vectors, S the sum of
their dimension) is the centred value times n, exact. One pass sums the squares of y_i for every dimension
and of y_i + y_j for every pair of dimensions, in whole numbers without rounding. Since

    sum (y_i + y_j)^2 - sum y_i^2 - sum y_j^2 = 2 sum y_i y_j,

differences of these variances are the cross-covariances. The matrix (as many rows as an embedding
has entries) is rounded once, when it becomes doubles for ``eigh``; the vectors themselves stay distributed.

Defined results: vectors that are null or hold null or non-finite entries take no part, and neither do
those whose length is not the most frequent one (of equally frequent ones the longest); repeated rows
count as often as they occur; rows with a null id are rows like any other; components whose eigenvalue is zero up to
rounding cannot be whitened and give no rows; without vectors there are no rows; entries too large for
64 bits once they are multiplied by n are an error. Columns beside the id and the
vector are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.llm.shared import written

LIMB_BITS = 24
ROWS = 1 << 12  # rows squared at a time: ROWS * 2^(2 * LIMB_BITS + 2) stays below 2^63


def whole_numbers(vector: Column, scale: int, offset: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long") + F.lit(offset))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def exact_square_sums(z: np.ndarray) -> list[int]:
    """Sums of the squares of the columns of whole numbers, whatever their size. A number is cut into
    limbs of ``LIMB_BITS`` bits; sums of products of limbs fit 64 bits."""
    totals = [0] * z.shape[1]
    for start in range(0, len(z), ROWS):
        part = np.abs(z[start : start + ROWS])
        limbs = []
        while part.any():
            limbs.append(part & ((1 << LIMB_BITS) - 1))
            part = part >> LIMB_BITS
        for p in range(len(limbs)):
            for q in range(p, len(limbs)):
                found = np.einsum("ij,ij->j", limbs[p], limbs[q]).tolist()
                shift = LIMB_BITS * (p + q) + (p != q)
                totals = [t + (f << shift) for t, f in zip(totals, found)]
    return totals


def row_square_sums(y: np.ndarray) -> list[Decimal]:
    """Exact sum of the squares of every row."""
    most = int(np.abs(y).max(initial=0))
    if most * most * y.shape[1] < 1 << 62:
        return [Decimal(v) for v in (y * y).sum(axis=1).tolist()]
    return [Decimal(v) for start in range(0, len(y), ROWS) for v in exact_square_sums(np.ascontiguousarray(y[start : start + ROWS].T))]


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def centred_square_sums(vectors: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """(i, j, q): exact sum of (y_i + y_j)^2 over all vectors, and of y_i^2 where i = j. A task holds one
    number for each pair."""
    d, centre = len(sums), np.array(sums)

    def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [[0] * (d - i) for i in range(d)]
        for batch in batches:
            y = n * _matrix(batch, d) - centre
            for i in range(d):
                z = y[:, i:] + y[:, i : i + 1]
                z[:, 0] = y[:, i]
                totals[i] = [t + f for t, f in zip(totals[i], exact_square_sums(z))]
        if any(map(any, totals)):
            at = [(i, i + k, Decimal(t)) for i, row in enumerate(totals) for k, t in enumerate(row)]
            i, j, q = zip(*at)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(q, pa.decimal128(38, 0))], names=["i", "j", "q"])

    found = vectors.select("x").mapInArrow(squares, "i int, j int, q decimal(38,0)")
    return found.groupBy("i", "j").agg(F.sum("q").alias("q"))


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n), every entry the exact value rounded once."""
    d = len(sums)
    q = {(r.i, r.j): int(r.q) for r in centred_square_sums(vectors, n, sums).toLocalIterator()}
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cross = 2 * q.get((i, i), 0) if i == j else q.get((i, j), 0) - q.get((i, i), 0) - q.get((j, j), 0)
            v[i, j] = v[j, i] = cross / (2 * n**3)  # Python's division of whole numbers rounds once
    return v


def principal(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) by falling eigenvalue; those that are zero up to rounding
    are left out. The largest entry of a vector is positive."""
    if not len(v):
        return np.zeros(0), np.zeros((0, 0))
    e, vectors = np.linalg.eigh(v)
    e, vectors = e[::-1][:components], vectors[:, ::-1][:, :components]
    real = e > max(e[:1].max(initial=0), 0) * len(v) * np.finfo(float).eps
    e, vectors = e[real], vectors[:, real]
    return e, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(e))])


def whiten(rows: DataFrame, components: int = 8, scale: int = 1024, offset: int = 100_000, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for every vector and component: id, component (from 1), n, deviation (exact sum of the
    squares of y, decimal), whitened, explained (share of the variance) and identity_error (largest
    difference of the whitened covariance from the identity)."""
    schema = f"id {rows.schema[id].dataType.simpleString()}, deviation decimal(38,0), w array<double>"
    x = F.when(usable(rows[vector]), whole_numbers(rows[vector], scale, offset))
    kept = written(rows.select(rows[id].alias("id"), x.alias("x")).where("x IS NOT NULL"), "vectors")
    width = kept.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    n, d = (width["n"], width["d"]) if width else (0, 0)
    vectors = kept.where(F.size("x") == d)
    total = vectors.select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"), F.max(F.abs("col")).alias("most"))
    total = sorted(total.collect()) if n else []  # one row for each dimension
    if any(n * r.most >= 1 << 62 for r in total):
        raise ValueError("entries times the number of vectors do not fit 64 bits; use a smaller scale")
    sums = [int(r.s) for r in total]
    v = covariance(vectors, n, sums) if n else np.zeros((0, 0))
    e, axes = principal(v, components)
    centre, scaled, explained = np.array(sums, dtype=np.int64), axes / np.sqrt(e), (e / np.trace(v)).tolist()

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                y = n * _matrix(batch, d) - centre
                w = (y / n) @ scaled
                ends = pa.array(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32) if w.size else np.zeros(len(w) + 1, np.int32))
                lists = pa.ListArray.from_arrays(ends, pa.array(w.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(row_square_sums(y), pa.decimal128(38, 0)), lists], names=["id", "deviation", "w"])

    found = written(vectors.mapInArrow(project, schema), "whitened")
    error = identity_error(found, len(e))
    share = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    return found.select("id", "deviation", F.posexplode("w").alias("_at", "whitened")).select(
        F.col("id").alias(id), (F.col("_at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("_at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of the whitened values (centred first) less the identity."""
    if not components:
        return 0.0
    means = whitened.agg(*[F.avg(F.get("w", F.lit(k))).alias(f"m{k}") for k in range(components)]).first()
    centred = [F.get("w", F.lit(k)) - F.lit(means[k]) for k in range(components)]
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    found = whitened.agg(*[F.avg(centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max((abs(c - (a == b)) for (a, b), c in zip(pairs, found)), default=0.0)
