"""Record-to-region assignment with overlap semantics, and the missing-contig report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortac.constants import INT_MAX
from cohortac.session import broadcast_if_bounded

# Regions come from a user list; far below this many rows they are broadcast.
MAX_BROADCAST_REGIONS = 1_000_000


def overlaps(rec_pos, rec_end, begin, end) -> Column:
    """Record [pos, end] overlaps region [begin, end] (1-based, inclusive, NULL = open)."""
    return (rec_end >= F.coalesce(begin, F.lit(1))) & (rec_pos <= F.coalesce(end, F.lit(INT_MAX)))


def region_overlap_scan(df: DataFrame, contig: str, begin: int | None = None, end: int | None = None) -> DataFrame:
    """Records of one region, including records that start before it but reach into it.

    A plain predicate on contig/pos/end: on a Parquet table partitioned by contig it prunes
    partitions and pushes the pos bound into the scan.
    """
    cond = F.col("contig") == F.lit(contig)
    if end is not None:
        cond = cond & (F.col("pos") <= F.lit(int(end)))
    if begin is not None:
        cond = cond & (F.col("end") >= F.lit(int(begin)))
    return df.where(cond)


BIN_SIZE = 1 << 20  # 1 Mb position bins for the interval join
MAX_REGION_BINS = 64  # regions spanning more bins (and open-ended ones) are joined on contig only


def region_interval_join(df: DataFrame, regions: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_REGIONS,
                         bin_size: int = BIN_SIZE) -> DataFrame:
    """Give each record a ``region`` label; a record in k overlapping regions appears k times.

    Both sides of the join stay map-side while the region list, counted in bins, is within
    ``max_broadcast_rows``; records are then never shuffled.
    * Narrow regions are exploded over the ``bin_size`` bins they cover and records over the
      bins they span; the hash key is (contig, bin), so a record is only compared with the
      regions near it (an interval list with many regions per contig stays cheap). A pair is
      kept only in the bin of its first overlapping position, so it is emitted once.
    * Wide or open-ended regions (whole contigs, the default) sit in a sentinel bin that
      every record also carries, so they are matched on contig with the overlap test.
    One join, one pass over the records, whatever mix of regions is given.
    """
    r = regions.select(
        "region",
        F.col("contig").alias("_r_contig"),
        F.coalesce(F.col("begin"), F.lit(1)).cast("long").alias("_r_begin"),
        F.coalesce(F.col("end"), F.lit(INT_MAX)).cast("long").alias("_r_end"),
    )
    rec, keyed, cond = _binned(df, r, max_broadcast_rows, int(bin_size))
    return rec.join(keyed, cond, "inner").drop("_rbin", "_bin", "_r_contig", "_r_begin", "_r_end")


def _binned(df: DataFrame, r: DataFrame, max_broadcast_rows: int, bin_size: int) -> tuple[DataFrame, DataFrame, Column]:
    """(records with their bins, regions with theirs, the condition that joins them)."""
    b = F.lit(bin_size)
    narrow = (F.col("_r_end") - F.col("_r_begin")) < F.lit(bin_size * MAX_REGION_BINS)
    # Which kinds of regions exist (one small aggregate over the region list, never the records).
    n_bins = F.floor(F.col("_r_end") / b) - F.floor(F.col("_r_begin") / b) + 1
    sizes = r.agg(F.count_if(narrow).alias("n"), F.count_if(~narrow).alias("w"), F.sum(F.when(narrow, n_bins)).alias("bins")).first()
    n_narrow, n_wide = int(sizes["n"]), int(sizes["w"])
    WIDE = F.lit(-1).cast("long")
    # Wide regions sit in the sentinel bin -1; narrow ones are exploded over their bins.
    keyed = r.select(
        "*",
        F.explode(
            F.when(narrow, F.sequence(F.floor(F.col("_r_begin") / b), F.floor(F.col("_r_end") / b))).otherwise(F.array(WIDE))
        ).alias("_bin"),
    )
    rec_bins = F.sequence(F.floor(F.col("pos") / b), F.floor(F.greatest("pos", "end") / b))
    if n_narrow == 0:
        rec = df.select("*", WIDE.alias("_rbin"))
    elif n_wide == 0:
        rec = df.select("*", F.explode(F.coalesce(rec_bins, F.array(WIDE))).alias("_rbin"))
    else:
        rec = df.select("*", F.explode(F.concat(F.array(WIDE), F.coalesce(rec_bins, F.array().cast("array<bigint>")))).alias("_rbin"))
    bound = n_wide + int(sizes["bins"] or 0)
    overlap = (F.col("end") >= F.col("_r_begin")) & (F.col("pos") <= F.col("_r_end"))
    # a narrow pair is kept only in the bin of its first overlapping position (emitted once)
    first_bin = F.floor(F.greatest(F.col("pos").cast("long"), F.col("_r_begin")) / b)
    cond = (
        (F.col("contig") == F.col("_r_contig"))
        & (F.col("_rbin") == F.col("_bin"))
        & overlap
        & ((F.col("_bin") == WIDE) | (F.col("_bin") == first_bin))
    )
    return rec, broadcast_if_bounded(keyed, max_broadcast_rows, bound), cond


def merged_regions(regions: DataFrame) -> DataFrame:
    """(contig, begin, end, before): the regions of a contig run together where they overlap, open ends
    closed; ``before`` is the end of the one before (0 for the first)."""
    r = regions.select(
        "contig", F.coalesce(F.col("begin"), F.lit(1)).cast("long").alias("begin"), F.coalesce(F.col("end"), F.lit(INT_MAX)).cast("long").alias("end")
    )
    w = Window.partitionBy("contig").orderBy("begin", "end")  # the region list, not the records
    reached = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    starts = r.withColumn("_new", F.when(F.col("begin") <= reached, 0).otherwise(1))
    runs = starts.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    runs = runs.groupBy("contig", "_run").agg(F.min("begin").alias("begin"), F.max("end").alias("end"))
    before = F.lag("end", 1, 0).over(Window.partitionBy("contig").orderBy("begin"))
    return runs.select("contig", "begin", "end", before.alias("before"))


def records_in_regions(df: DataFrame, regions: DataFrame, or_where: Column | None = None, max_broadcast_rows: int = MAX_BROADCAST_REGIONS,
                       bin_size: int = BIN_SIZE) -> DataFrame:
    """The records that overlap a region, each once, and the rows without a position (header lines) where
    ``or_where`` holds.

    A semi-join by bins: the regions of a contig are run together first, so that a record has one first
    run that it overlaps (the run before ends before the record starts), and it is kept with that one only.
    """
    runs = merged_regions(regions).select(
        F.col("contig").alias("_r_contig"), F.col("begin").alias("_r_begin"), F.col("end").alias("_r_end"), F.col("before").alias("_r_before")
    )
    rec, keyed, cond = _binned(df, runs, max_broadcast_rows, int(bin_size))
    cond = cond & (F.col("_r_before") < F.col("pos"))
    if or_where is None:
        return rec.join(keyed, cond, "left_semi").drop("_rbin")
    rows = rec.join(keyed, cond, "left").where(F.col("_r_contig").isNotNull() | or_where)
    return rows.drop("_rbin", "_bin", "_r_contig", "_r_begin", "_r_end", "_r_before")


def missing_contigs(regions: DataFrame, file_contigs: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Regions whose contig is absent from some files' headers: (region, contig, n_files_missing).

    A region with a missing contig yields no records for that file; this reports it.
    ``file_contigs`` holds (file, contig) pairs from the headers; ``files`` all files, also those
    whose header names no contig (default: the files of ``file_contigs``).
    """
    fc = file_contigs.select("file", "contig").distinct()
    n_files = (fc if files is None else files).select(F.countDistinct("file")).scalar()
    with_contig = fc.groupBy("contig").agg(F.count(F.lit(1)).alias("_n_have"))
    rep = (
        regions.select("region", "contig")
        .join(with_contig, "contig", "left")
        .select("*", n_files.alias("_n_files"))
        .select(
            "region",
            "contig",
            (F.col("_n_files") - F.coalesce(F.col("_n_have"), F.lit(0))).cast("int").alias("n_files_missing"),
        )
    )
    return rep.where(F.col("n_files_missing") > 0)
