"""Sex inference from chrX genotypes and the dataset's sample numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.constants import DATASET_VERSION, HET_FRACTION_LIMIT, PAR1_END, PAR2_X_BEGIN

# The window scanned for inference: chrX between the PARs, with record-extent overlap.
INFERENCE_CONTIG = "chrX"
INFERENCE_BEGIN = PAR1_END + 1
INFERENCE_END = PAR2_X_BEGIN - 1


def inference_window(genotypes: DataFrame) -> DataFrame:
    """Records overlapping chrX non-PAR; gVCF blocks included, no depth or quality filter."""
    return genotypes.where(
        (F.col("contig") == INFERENCE_CONTIG)
        & (F.col("pos") <= F.lit(INFERENCE_END))
        & (F.col("end") >= F.lit(INFERENCE_BEGIN))
    )


def zygosity_event(gt, on_unsupported: str = "error"):
    """'hom', 'het' or NULL (no event) for one call, as used by sex inference.

    Diploid equal alleles (including 0/0) are hom; other diploid calls, half-missing ones
    included, are het; a haploid allele above 1 is het; fully missing calls are no event.
    Haploid 0 or 1 and ploidy of 3 or more are unsupported: an error by default, or with
    ``on_unsupported='drop'`` haploid 0/1 count as hom (single copy) and other ploidies are skipped.
    """
    g = F.col(gt) if isinstance(gt, str) else gt
    n = F.size(g)
    g0, g1 = F.get(g, 0), F.get(g, 1)
    missing = ((n == 1) & g0.isNull()) | ((n == 2) & g0.isNull() & g1.isNull())
    cls = (
        F.when(missing, F.lit(None).cast("string"))
        .when((n == 2) & (g0 == g1), F.lit("hom"))
        .when(n == 2, F.lit("het"))
        .when((n == 1) & (g0 > 1), F.lit("het"))
    )
    if on_unsupported == "error":
        return cls.otherwise(
            F.raise_error(F.concat(F.lit("chrX call of unsupported ploidy, no sex can be inferred from it: "), F.to_json(g)))
        )
    if on_unsupported == "drop":
        return cls.when(n == 1, F.lit("hom"))
    raise ValueError(f"on_unsupported must be 'error' or 'drop', not {on_unsupported!r}")


def zygosity_counts(genotypes: DataFrame, on_unsupported: str = "error") -> DataFrame:
    """Per (file, sample_rank): number of hom and het events on chrX non-PAR.

    One partial+final aggregate; a hot sample collapses map-side before the shuffle.
    """
    ev = inference_window(genotypes).select(
        "file", "sample_rank", zygosity_event("gt", on_unsupported).alias("event")
    )
    return ev.groupBy("file", "sample_rank").agg(
        F.count_if(F.col("event") == "hom").alias("n_hom"),
        F.count_if(F.col("event") == "het").alias("n_het"),
    )


def sex_from_counts(n_hom, n_het):
    """'XY' when het / (hom + het) < 0.2; 'XX' otherwise and when there are no events."""
    hom, het = F.col(n_hom), F.col(n_het)
    total = hom + het
    return F.when(total == 0, F.lit("XX")).when(het / total < F.lit(HET_FRACTION_LIMIT), F.lit("XY")).otherwise("XX")


def infer_sex(genotypes: DataFrame, header_samples: DataFrame | None = None, on_unsupported: str = "error") -> DataFrame:
    """Sex of every header sample: (file, sample_rank, sample, n_hom, n_het, sex).

    Samples without any chrX non-PAR event are kept (left join from the header) and are XX.
    """
    if header_samples is None:
        # Every sample seen in the calls: one aggregate over all calls, the events counted
        # only inside the inference window (samples without events get zero counts).
        ev = F.when(
            (F.col("contig") == INFERENCE_CONTIG)
            & (F.col("pos") <= F.lit(INFERENCE_END))
            & (F.col("end") >= F.lit(INFERENCE_BEGIN)),
            zygosity_event("gt", on_unsupported),
        )
        # calls parsed from VCF text carry no sample name (it lives in the header)
        name = F.col("sample") if "sample" in genotypes.columns else F.lit(None).cast("string").alias("sample")
        joined = genotypes.select("file", "sample_rank", name, ev.alias("event")).groupBy(
            "file", "sample_rank", "sample"
        ).agg(
            F.count_if(F.col("event") == "hom").alias("n_hom"),
            F.count_if(F.col("event") == "het").alias("n_het"),
        )
    else:
        counts = zygosity_counts(genotypes, on_unsupported)
        joined = header_samples.join(counts, ["file", "sample_rank"], "left")
    return joined.select(
        "file",
        F.col("sample_rank").cast("int").alias("sample_rank"),
        "sample",
        F.coalesce(F.col("n_hom"), F.lit(0)).cast("long").alias("n_hom"),
        F.coalesce(F.col("n_het"), F.lit(0)).cast("long").alias("n_het"),
    ).withColumn("sex", sex_from_counts("n_hom", "n_het"))


def sample_number(samples: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Number of XX and XY samples over all files (both always present), or for each value of ``by``."""
    return samples.groupBy(*by).agg(
        F.count_if(F.col("sex") == "XX").cast("int").alias("XX"),
        F.count_if(F.col("sex") == "XY").cast("int").alias("XY"),
    )


def dataset_info(samples: DataFrame, min_dp: int, min_gq: int, min_ab: float, settings: Column | None = None,
                 regions: DataFrame | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """One-row dataset metadata: version, sample_number{XX,XY}, AC0_filter{min_DP,min_GQ,min_AB}; with
    ``regions`` also the other count settings and ``cohorts``, the sample numbers by region list. With ``by`` (a
    samples column that tells centers apart) a row for each of them."""
    info = sample_number(samples, by).select(
        F.lit(DATASET_VERSION).alias("version"),
        F.struct("XX", "XY").alias("sample_number"),
        F.struct(
            F.lit(int(min_dp)).cast("int").alias("min_DP"),
            F.lit(int(min_gq)).cast("int").alias("min_GQ"),
            F.lit(float(min_ab)).cast("double").alias("min_AB"),
        ).alias("AC0_filter"),
    )
    if regions is None:
        return info
    listed = regions.agg(F.array_sort(F.collect_set("region"))).scalar()
    n = F.col("sample_number")
    return info.select("*", settings.alias("settings"), F.array(F.struct(listed.alias("regions"), n["XX"].alias("XX"), n["XY"].alias("XY"))).alias("cohorts"))
