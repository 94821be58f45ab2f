"""Cross-center merge of count datasets before finalize.

Every count measure is a sum (allele counts, discard numbers, n_samples, DP_sum, DP2_sum),
so merging is a union followed by a re-sum per variant: the same partial/final aggregate
as the count step, with no per-center state to reconcile. Sample numbers add up, by region
list where the centers counted different regions; all count settings must agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.constants import COUNT_SUMS, DATASET_VERSION, INFO_SCHEMA
from cohortac.operators.counts import VARIANT_KEY
from cohortac.session import broadcast_if_bounded


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def merge_counts(counts: list[DataFrame] | DataFrame) -> DataFrame:
    """Counts of several centers re-summed per variant. One frame with all centers' rows (a scan of all
    datasets, or counts by center) keeps the plan the same whatever their number."""
    u = union_all(counts) if isinstance(counts, list) else counts
    return u.groupBy(*VARIANT_KEY).agg(
        *[F.sum(c).cast("int").alias(c) for c in COUNT_SUMS],
        F.sum("n_samples").cast("int").alias("n_samples"),
        F.sum("DP_sum").cast("double").alias("DP_sum"),
        F.sum("DP2_sum").cast("double").alias("DP2_sum"),
    )


def added_counts(base: DataFrame, new: DataFrame) -> DataFrame:
    """Re-summed counts of the regions that ``new`` holds; the other regions of ``base`` stay as they are."""
    touched = new.select("region").distinct()
    return merge_counts(base.join(broadcast_if_bounded(touched), "region", "left_semi").unionByName(new))


def _whole(info: DataFrame) -> DataFrame:
    """An info row with all parts (those it lacks are null)."""
    missing = [f for f in INFO_SCHEMA.fields if f.name not in info.columns]
    return info.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*INFO_SCHEMA.fieldNames())


def merge_info(infos: list[DataFrame] | DataFrame) -> DataFrame:
    """Sum sample numbers, in all and by region list; an error when the centers used different
    filters or other count settings. ``infos``: one frame with a row for each center, or one frame each."""
    u = union_all([_whole(i) for i in infos]) if isinstance(infos, list) else _whole(infos)
    agg = u.agg(
        F.sum("sample_number.XX").cast("int").alias("XX"),
        F.sum("sample_number.XY").cast("int").alias("XY"),
        F.size(F.collect_set(F.to_json("AC0_filter"))).alias("_n_filters"),
        F.size(F.collect_set(F.to_json("settings"))).alias("_n_settings"),
        F.first("AC0_filter").alias("AC0_filter"),
        F.first("settings", ignorenulls=True).alias("settings"),
        F.count_if(F.col("cohorts").isNull()).alias("_n_unlisted"),
    )
    by_regions = u.select(F.explode("cohorts").alias("c")).groupBy("c.regions").agg(F.sum("c.XX").cast("int").alias("XX"), F.sum("c.XY").cast("int").alias("XY"))
    cohorts = by_regions.agg(F.array_sort(F.collect_list(F.struct("regions", "XX", "XY")))).scalar()
    checked = F.when(
        F.col("_n_filters") > 1, F.raise_error(F.lit("Count datasets were made with different filter settings"))
    ).when(
        F.col("_n_settings") > 1, F.raise_error(F.lit("Count datasets were made with different count settings"))
    ).otherwise(F.col("AC0_filter"))
    return agg.select(
        F.lit(DATASET_VERSION).alias("version"),
        F.struct("XX", "XY").alias("sample_number"),
        checked.alias("AC0_filter"),
        "settings",
        F.when(F.col("_n_unlisted") == 0, cohorts).alias("cohorts"),
    )
