"""Pile -> counts: additive per-variant sums, depth moments and depth distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.constants import COUNT_SUMS

VARIANT_KEY = ["region", "contig", "pos", "ref", "alt"]


def count_aggregates(prefix: str = "") -> list:
    """The count measures over pile rows; all of them are sums, so they merge by re-summing."""
    return [F.sum(F.col(c)).cast("int").alias(c) for c in COUNT_SUMS] + [
        F.count(F.lit(1)).cast("int").alias("n_samples"),
        F.sum(F.col("DP")).cast("double").alias("DP_sum"),
        F.sum(F.col("DP").cast("double") * F.col("DP").cast("double")).alias("DP2_sum"),
    ]


def allele_counts(pile: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per (region, pos, ref, alt): summed allele counts, discard numbers, number of pile
    rows (n_samples) and the depth moments DP_sum, DP2_sum; with ``by`` (a pile column that tells centers
    apart) one for each of them.

    Partial aggregation runs before the shuffle, so a variant carried by a third of all
    calls still arrives as one row per map task.
    """
    return pile.groupBy(*by, *VARIANT_KEY).agg(*count_aggregates())


def depth_moments(pile: DataFrame) -> DataFrame:
    """Only the mergeable depth statistics per variant."""
    return pile.groupBy(*VARIANT_KEY).agg(
        F.count(F.lit(1)).cast("int").alias("n_samples"),
        F.sum(F.col("DP")).cast("double").alias("DP_sum"),
        F.sum(F.col("DP").cast("double") * F.col("DP").cast("double")).alias("DP2_sum"),
    )


def depth_distribution(pile: DataFrame) -> DataFrame:
    """The per-variant list of depths as a multiset: one row per (variant, DP) with its number of
    calls. Same information as a sorted DP list, but built by a combinable aggregate, so no
    variant's depths are ever gathered into one row or one task."""
    return pile.groupBy(*VARIANT_KEY, "DP").agg(F.count(F.lit(1)).cast("int").alias("n_calls"))


def sorted_counts(counts: DataFrame) -> DataFrame:
    """Counts in (region, pos, ref, alt) order (global range-partitioned sort)."""
    return counts.orderBy("region", "pos", "ref", "alt")
