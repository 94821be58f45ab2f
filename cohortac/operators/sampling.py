"""Exact-size per-group selection: random subsamples and first-N caps per contig.

``smallest_k_per_group`` picks, for every group, the k rows with the smallest order key
without gathering a group into one task, and reads its input twice. The first pass counts the rows of every
(group, bucket); buckets have the key's leading bits, so they need no bounds and the counts merge (partial
sums in every task, at most 64 x 2^bits rows a group). They tell the bucket that holds the group's k-th row.
The second pass drops all rows beyond that bucket and writes the rest: rows of earlier buckets are the
result, those of the k-th row's bucket, a small share, are ranked. If that bucket is still large, it
alone is cut finer (up to ``max_levels`` times). Identical rows are counted instead of ranked one by
one, so a key shared by many copies of one record stays cheap; what is left to rank are distinct rows
sharing one exact key value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortac.session import broadcast_if_bounded, reliable_checkpoint

LONG_MASK = 0x7FFFFFFFFFFFFFFF


def leading_bits(key: str, bits: int) -> tuple[Column, Column]:
    """(bucket, shift) of a non-negative LONG: its leading ``bits`` + 1 bits and how many were cut off. Buckets are in
    the order of the keys, about 2^bits of them for every doubling of the key."""
    shift = F.greatest(F.length(F.bin(key)) - (bits + 1), F.lit(0)).cast("int")
    return shift.cast("long") * (2 << bits) + F.call_function("shiftright", F.col(key), shift), shift


def smallest_k_per_group(
    df: DataFrame,
    group_cols: list[str],
    key: str,
    tiebreak: list[str],
    k: DataFrame | Column,
    bits: int = 12,
    buckets: int = 1 << 16,
    max_boundary_rows: int = 1_000_000,
    max_levels: int = 4,
) -> DataFrame:
    """Rows of ``df`` whose rank by (key, *tiebreak, all columns) inside their group is <= k.

    ``key`` is a non-negative LONG column; ``k`` an expression of the group's number of rows
    ``_n``, or a DataFrame with the group columns and ``k``. Identical rows may be chosen in either order (the
    output is the same). ``df`` is read twice and must give the same rows both times.
    """
    cols, (bucket, shift) = df.columns, leading_bits(key, bits)
    hist = reliable_checkpoint(df.groupBy(*group_cols, bucket.alias("_b"), shift.alias("_shift")).agg(F.count(F.lit(1)).alias("_cnt")))
    sizes = hist.groupBy(*group_cols).agg(F.sum("_cnt").alias("_n"))
    sized = sizes.withColumn("k", k) if isinstance(k, Column) else sizes.join(k.select(*group_cols, "k"), group_cols)
    need = sized.select(*group_cols, F.least(F.col("k").cast("long"), F.col("_n")).alias("_need")).where(F.col("_need") > 0)
    w = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = hist.withColumn("_cum", F.sum("_cnt").over(w)).join(need, group_cols)  # rows of the histogram
    bound = upto.where((F.col("_cum") - F.col("_cnt") < F.col("_need")) & (F.col("_need") <= F.col("_cum")))
    # The bucket is shift * 2^(bits + 1) + the key's leading bits: its keys share those.
    lead = F.col("_b") - F.col("_shift").cast("long") * (2 << bits)
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_shift"))
    bound = reliable_checkpoint(
        bound.select(
            *group_cols, F.col("_b").alias("_last"), (F.col("_need") - (F.col("_cum") - F.col("_cnt"))).alias("_need"),
            (lead * width).alias("_lo"), (lead * width + (width - 1)).alias("_hi"), "_cnt",
        )
    )
    most = bound.agg(F.max("_cnt").alias("m")).first()["m"]
    if most is None:
        return df.limit(0)
    near = df.withColumn("_b", bucket).join(broadcast_if_bounded(bound.select(*group_cols, "_last")), group_cols).where(F.col("_b") <= F.col("_last"))
    near = reliable_checkpoint(near.select(*cols, (F.col("_b") < F.col("_last")).alias("_sure")))
    sure, edge = near.where("_sure").select(*cols), near.where(~F.col("_sure")).select(*cols)
    return sure.unionByName(_smallest_in_range(edge, group_cols, key, tiebreak, bound.drop("_last"), most, buckets, max_boundary_rows, max_levels))


def _smallest_in_range(df, group_cols, key, tiebreak, state, rows, buckets, max_boundary_rows, max_levels) -> DataFrame:
    """The ``_need`` smallest rows of every group, where all its rows have keys from ``_lo`` to ``_hi``; no group
    has more than ``rows``."""
    state = state.drop("_cnt")
    taken: list[DataFrame] = []
    cand = df
    for _level in range(max_levels if rows > max_boundary_rows else 0):
        st = state.select(
            *group_cols,
            "_need",
            "_lo",
            "_hi",
            F.greatest(F.lit(1), F.ceil((F.col("_hi") - F.col("_lo") + 1) / F.lit(buckets))).cast("long").alias("_step"),
        )
        c = (
            cand.join(broadcast_if_bounded(st), group_cols)
            .where((F.col(key) >= F.col("_lo")) & (F.col(key) <= F.col("_hi")))
            .withColumn("_b", F.floor((F.col(key) - F.col("_lo")) / F.col("_step")).cast("long"))
        )
        hist = c.groupBy(*group_cols, "_b").agg(F.count(F.lit(1)).alias("_cnt"))
        w = Window.partitionBy(*group_cols).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hist = hist.withColumn("_cum", F.sum("_cnt").over(w))
        bound = (
            hist.join(st.select(*group_cols, "_need", "_lo", "_step"), group_cols)
            .where((F.col("_cum") - F.col("_cnt") < F.col("_need")) & (F.col("_need") <= F.col("_cum")))
            .select(
                *group_cols,
                F.col("_b").alias("_bstar"),
                (F.col("_need") - (F.col("_cum") - F.col("_cnt"))).alias("_need2"),
                (F.col("_lo") + F.col("_b") * F.col("_step")).alias("_lo2"),
                (F.col("_lo") + (F.col("_b") + 1) * F.col("_step") - 1).alias("_hi2"),
                F.col("_cnt").alias("_bcnt"),
                "_step",
            )
        )
        bound = reliable_checkpoint(bound)
        bb = broadcast_if_bounded(bound.select(*group_cols, "_bstar"))
        base_cols = df.columns
        taken.append(c.join(bb, group_cols).where(F.col("_b") < F.col("_bstar")).select(*base_cols))
        cand = c.join(bb, group_cols).where(F.col("_b") == F.col("_bstar")).select(*base_cols)
        state = bound.select(
            *group_cols, F.col("_need2").alias("_need"), F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi")
        )
        top = bound.agg(F.max("_bcnt").alias("m"), F.max("_step").alias("s")).collect()[0]
        if top["m"] is None or top["m"] <= max_boundary_rows or top["s"] <= 1:
            break
    # Rank only the rows of each group's final boundary bucket. Identical rows are first
    # collapsed to (row, copies) by a combinable aggregate, so a bucket full of copies is
    # ranked as a handful of distinct rows; the copies are expanded again afterwards.
    final = cand.join(broadcast_if_bounded(state), group_cols).where(
        (F.col(key) >= F.col("_lo")) & (F.col(key) <= F.col("_hi"))
    )
    distinct = final.groupBy(*df.columns, "_need").agg(F.count(F.lit(1)).alias("_copies"))
    rw = (
        Window.partitionBy(*group_cols)
        .orderBy(F.col(key), *[F.col(c) for c in tiebreak], *[F.col(c) for c in df.columns])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    distinct = distinct.withColumn("_before", F.coalesce(F.sum("_copies").over(rw), F.lit(0)))
    take = F.least(F.col("_copies"), F.col("_need") - F.col("_before"))
    chunk = 1 << 16
    final = (
        distinct.where(take > 0)
        .select(*df.columns, take.alias("_take"))
        .select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_take") - 1) / chunk).cast("long"))).alias("_chunk"))
        .repartition(*group_cols, "_chunk")
        .select(
            *df.columns,
            F.explode(
                F.sequence(F.lit(1), F.least(F.lit(chunk), F.col("_take") - F.col("_chunk") * chunk).cast("long"))
            ).alias("_i"),
        )
        .select(*df.columns)
    )
    out = taken[0] if taken else None
    for t in taken[1:]:
        out = out.unionByName(t)
    return final if out is None else out.unionByName(final)


def hash_key(*cols) -> Column:
    """Non-negative pseudo-random LONG key from columns (xxhash64 with the sign bit cleared)."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(LONG_MASK))


def subsample_per_contig(
    records: DataFrame,
    replicas: int = 1,
    fraction: float = 0.25,
    min_size: int = 5,
    seed: int = 42,
    order_key: Column | None = None,
    tiebreak: list[str] | None = None,
    sort_output: bool = False,
) -> DataFrame:
    """Exact-size sample without replacement per (replica, contig), drawn independently per replica.

    With ``sort_output`` the sample comes back in the records' original order (replica,
    contig, pos), as a range-partitioned global sort.

    Size k = int(fraction * n); when k < ``min_size`` it is min(min_size, n). The rows keep
    their columns plus ``replica``. ``order_key`` (a LONG column over ``replica`` and the record
    columns) replaces the default seeded hash when a reproducible order is wanted.
    """
    cols = records.columns
    rep = records.select(F.explode(F.sequence(F.lit(0), F.lit(replicas - 1))).alias("replica"), *cols)
    key = order_key if order_key is not None else hash_key(F.lit(seed), F.col("replica"), *[F.col(c) for c in cols])
    rep = rep.withColumn("_key", key.cast("long"))
    k0 = F.floor(F.col("_n") * F.lit(float(fraction))).cast("long")
    k = F.when(k0 < min_size, F.least(F.lit(min_size).cast("long"), F.col("_n"))).otherwise(k0)
    out = smallest_k_per_group(rep, ["replica", "contig"], "_key", tiebreak or cols, k).drop("_key")
    return out.orderBy("replica", "contig", "pos") if sort_output else out


TIE_BITS = 31


def cap_per_contig(records: DataFrame, cap: int = 100_000, tie_key: Column | None = None,
                   tiebreak: list[str] | None = None) -> DataFrame:
    """The first ``cap`` records of every contig in position order.

    Records at one position are ordered by ``tie_key`` (a LONG in [0, 2^31); by default a hash
    of the whole record), then by the ``tiebreak`` columns. Position and tie key form one
    LONG order key, so even a position holding a third of all records is split by the
    histogram refinement instead of being ranked in one task.
    """
    cols = records.columns
    tk = tie_key if tie_key is not None else F.xxhash64(*[F.col(c) for c in cols]).bitwiseAND(F.lit((1 << TIE_BITS) - 1))
    r = records.withColumn("_key", F.col("pos").cast("long") * F.lit(1 << TIE_BITS) + tk.cast("long"))
    out = smallest_k_per_group(r, ["contig"], "_key", tiebreak or [c for c in cols if c != "pos"], F.lit(cap).cast("long"))
    return out.drop("_key")
