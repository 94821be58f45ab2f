"""Counts -> result: allele numbers per sex, depth mean and standard deviation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.session import broadcast_if_bounded
from cohortac.functions.genome import xx_ploidy, xy_ploidy


def nonzero_variants(counts: DataFrame) -> DataFrame:
    """Keep variants with at least one counted allele (ref rows and all-filtered variants go)."""
    return counts.where((F.col("XX_AC") > 0) | (F.col("XY_AC") > 0))


def with_sample_number(counts: DataFrame, info: DataFrame) -> DataFrame:
    """Attach N_XX, N_XY of the one-row dataset info as scalar subqueries, used as constants by
    every row (no join); an info table with more than one row is an error. Only if the info lists
    several region lists (a merge of datasets with different regions) are the numbers joined by
    region, which the planner broadcasts when the list of regions is counted small."""
    if "cohorts" in info.columns and (info.select(F.size("cohorts")).first() or [0])[0] > 1:
        cohort = info.select(F.explode("cohorts").alias("c")).select(F.explode("c.regions").alias("region"), "c.XX", "c.XY")
        numbers = cohort.groupBy("region").agg(F.sum("XX").cast("int").alias("_n_xx"), F.sum("XY").cast("int").alias("_n_xy"))
        return counts.join(broadcast_if_bounded(numbers), "region").select(*counts.columns, "_n_xx", "_n_xy")
    n_xx = info.select(F.col("sample_number.XX").cast("int")).scalar()
    n_xy = info.select(F.col("sample_number.XY").cast("int")).scalar()
    return counts.select("*", n_xx.alias("_n_xx"), n_xy.alias("_n_xy"))


def allele_number_columns() -> list[Column]:
    """XX_AN = (N_XX - XX_n_DP_discarded) * ploidy_XX(contig), XY_AN likewise with ploidy_XY(contig, pos)."""
    return [
        ((F.col("_n_xx") - F.col("XX_n_DP_discarded")) * xx_ploidy("contig")).cast("int").alias("XX_AN"),
        ((F.col("_n_xy") - F.col("XY_n_DP_discarded")) * xy_ploidy("contig", "pos")).cast("int").alias("XY_AN"),
    ]


def depth_mean() -> Column:
    return F.col("DP_sum") / F.col("n_samples")


def depth_std(mean: Column | None = None) -> Column:
    """Population standard deviation rebuilt from the merged sums:
    sqrt((DP2_sum - 2*mean*DP_sum + n*mean^2) / n); a radicand pushed below zero by
    rounding is taken as zero."""
    m = depth_mean() if mean is None else mean
    n = F.col("n_samples")
    radicand = (F.col("DP2_sum") - F.lit(2.0) * m * F.col("DP_sum") + n * (m * m)) / n
    return F.sqrt(F.greatest(radicand, F.lit(0.0)))


def finalize(counts: DataFrame, info: DataFrame) -> DataFrame:
    """Result rows: region, contig, pos, ref, alt, XX_AN, XX_AC, XX_AC_hom, XX_AC_hemi,
    XY_AN, XY_AC, XY_AC_hom, XY_AC_hemi, DP_mean, DP_std. Map-only: no shuffle."""
    c = with_sample_number(nonzero_variants(counts), info)
    xx_an, xy_an = allele_number_columns()
    return c.select(
        "region",
        "contig",
        "pos",
        "ref",
        "alt",
        xx_an,
        "XX_AC",
        "XX_AC_hom",
        "XX_AC_hemi",
        xy_an,
        "XY_AC",
        "XY_AC_hom",
        "XY_AC_hemi",
        depth_mean().alias("DP_mean"),
        depth_std().alias("DP_std"),
    )
