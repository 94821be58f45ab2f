"""The count -> finalize pipeline as lazy DataFrame plans (no output is written here).

``count_dataset`` is the whole 'count' step over a genotype table: sex inference,
pile, per-variant counts and the dataset info. Sex inference is materialised once in
the shared checkpoint folder: the plan needs it twice (the join and the info row), and
its size decides whether it may be broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortac.constants import DEFAULT_MIN_AB, DEFAULT_MIN_DP, DEFAULT_MIN_GQ
from cohortac.functions.genome import normalize_contig
from cohortac.functions.regions import regions_frame
from cohortac.operators.counts import allele_counts
from cohortac.operators.pile import build_pile, drop_gvcf_blocks, join_file_sexes, pile_of_calls
from cohortac.operators.regions import region_interval_join
from cohortac.operators.sex import dataset_info, infer_sex, inference_window
from cohortac.session import reliable_checkpoint
from cohortac.sources.vcf import sites_to_genotypes


@dataclass(frozen=True)
class Filters:
    min_dp: int = DEFAULT_MIN_DP
    min_gq: int = DEFAULT_MIN_GQ
    min_ab: float = DEFAULT_MIN_AB
    ab_index: str = "reference"
    on_unsupported: str = "error"
    # Rename 1..22/X/Y/M/MT contigs to the chr spelling before anything else, so sex
    # inference, the chrX/chrY rules and finalize ploidy also apply to such files.
    normalize_contigs: bool = False


@dataclass
class CountDataset:
    samples: DataFrame
    info: DataFrame
    counts: DataFrame


def samples_sex(genotypes: DataFrame, header_samples: DataFrame | None = None, on_unsupported: str = "error",
                materialize: bool = True) -> DataFrame:
    s = infer_sex(genotypes, header_samples, on_unsupported)
    return reliable_checkpoint(s) if materialize else s


def pile_for(genotypes: DataFrame, samples: DataFrame, regions=None, filters: Filters = Filters(), keep=()) -> DataFrame:
    spark = genotypes.sparkSession
    reg = regions if isinstance(regions, DataFrame) else regions_frame(spark, regions)
    if filters.normalize_contigs:
        reg = reg.withColumn("contig", normalize_contig("contig"))
    g = region_interval_join(genotypes, reg)
    return build_pile(
        g,
        samples,
        min_dp=filters.min_dp,
        min_gq=filters.min_gq,
        min_ab=filters.min_ab,
        ab_index=filters.ab_index,
        on_unsupported=filters.on_unsupported,
        keep=keep,
    )


def count_dataset(
    genotypes: DataFrame,
    regions=None,
    filters: Filters = Filters(),
    header_samples: DataFrame | None = None,
    samples: DataFrame | None = None,
    by: tuple[str, ...] = (),
) -> CountDataset:
    """Sex inference (unless ``samples`` is given), dataset info and per-variant counts of a
    genotype table. ``regions``: None (chr1..chr22, chrX, chrY, chrM), a region list or text,
    or a regions DataFrame. ``header_samples`` lists every sample of every file (VCF headers);
    without it the samples seen in the calls are used. With ``by`` (``file``: every file a center) info and
    counts have a row for each center, in the same one plan."""
    if filters.normalize_contigs:
        genotypes = genotypes.withColumn("contig", normalize_contig("contig"))
    if samples is None:
        samples = samples_sex(genotypes, header_samples, filters.on_unsupported)
    reg = regions if isinstance(regions, DataFrame) else regions_frame(genotypes.sparkSession, regions)
    info = info_for(samples, reg, filters, by)
    counts = allele_counts(pile_for(genotypes, samples, reg, filters, keep=by), by)
    return CountDataset(samples=samples, info=info, counts=counts)


def pile_for_sites(sites: DataFrame, samples: DataFrame, regions=None, filters: Filters = Filters()) -> DataFrame:
    """Pile of VCF records. Region join, gVCF and no-ALT rules and the sample sexes (one array per file)
    are settled per record; only then are the samples exploded and their calls parsed."""
    reg = regions if isinstance(regions, DataFrame) else regions_frame(sites.sparkSession, regions)
    if filters.normalize_contigs:
        reg = reg.withColumn("contig", normalize_contig("contig"))
    here = drop_gvcf_blocks(region_interval_join(sites, reg), filters.on_unsupported)
    calls = sites_to_genotypes(join_file_sexes(here, samples))
    return pile_of_calls(calls, filters.min_dp, filters.min_gq, filters.min_ab, filters.ab_index, filters.on_unsupported)


def count_sites(sites: DataFrame, header_samples: DataFrame, regions=None, filters: Filters = Filters()) -> CountDataset:
    """``count_dataset`` for VCF records (re-readable: inference and counts each read them)."""
    if filters.normalize_contigs:
        sites = sites.withColumn("contig", normalize_contig("contig"))
    window = sites_to_genotypes(inference_window(sites))
    samples = reliable_checkpoint(infer_sex(window, header_samples, filters.on_unsupported))
    reg = regions if isinstance(regions, DataFrame) else regions_frame(sites.sparkSession, regions)
    counts = allele_counts(pile_for_sites(sites, samples, reg, filters))
    return CountDataset(samples=samples, info=info_for(samples, reg, filters), counts=counts)


def info_for(samples: DataFrame, regions: DataFrame, filters: Filters, by: tuple[str, ...] = ()) -> DataFrame:
    settings = F.struct(
        F.lit(filters.ab_index).alias("ab_index"),
        F.lit(filters.on_unsupported).alias("on_unsupported"),
        F.lit(filters.normalize_contigs).alias("normalize_contigs"),
    )
    return dataset_info(samples, filters.min_dp, filters.min_gq, filters.min_ab, settings, regions, by)
