"""Write jobs: count (VCF files -> count dataset), finalize (counts -> result), merge (datasets -> dataset).

``count`` scans the VCF text once. Header lines and the records of the wanted contigs (and chrX,
for sex inference) are written together as one Parquet table in the shared checkpoint folder, with
only the FORMAT fields that are counted; sex inference then reads only the chrX part. The table
is removed when the job ends.
"""

from __future__ import annotations

import logging
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.functions.genome import normalize_contig
from cohortac.functions.regions import regions_frame
from cohortac.operators.finalize import finalize
from cohortac.operators.merge import added_counts, merge_counts, merge_info
from cohortac.operators.regions import missing_contigs, records_in_regions
from cohortac.operators.sex import INFERENCE_CONTIG
from cohortac.plans.pipeline import Filters, count_sites, pile_for_sites
from cohortac.session import reliable_checkpoint, remove_path, scratch_path, tune
from cohortac.sources import tables
from cohortac.sources.vcf import (
    FORMAT_KEYS,
    file_label,
    header_contigs,
    header_float_keys,
    header_samples,
    is_supported_name,
    read_vcf_lines,
    site_columns,
    with_float_keys,
)

log = logging.getLogger(__name__)

HEADER, CHRX, OTHER = "header", "chrX", "other"
KEPT_HEADERS = r"^#CHROM|^##contig=|^##FORMAT="


MAX_PUSHED_CONTIGS = 1000


def wanted_regions(regions: DataFrame, normalize: bool = False) -> DataFrame:
    """(contig, begin, end) of the records that a count reads: the regions, and chrX from start to end. With
    ``normalize`` contigs are in the chr spelling."""
    name = normalize_contig("contig") if normalize else F.col("contig")
    inference = regions.sparkSession.range(1).select(
        F.lit(INFERENCE_CONTIG).alias("contig"), F.lit(1).cast("long").alias("begin"), F.lit(None).cast("long").alias("end")
    )
    return regions.select(name.alias("contig"), F.col("begin").cast("long").alias("begin"), F.col("end").cast("long").alias("end")).unionByName(inference)


def ingest_vcf(spark: SparkSession, paths: list[str], path: str, regions: DataFrame | None = None, normalize: bool = False) -> tuple[DataFrame, DataFrame]:
    """One pass over the VCF text into a Parquet table at ``path`` -> (sites, header lines).

    With ``regions`` only the records that overlap one are kept (and chrX): lines of other contigs are dropped by the
    reader, the rest by a binned semi-join on the fixed fields. FORMAT and sample columns are split only then.
    """
    wanted, contigs = None, None
    if regions is not None:
        wanted = wanted_regions(regions, normalize)
        names = [] if normalize else [r.contig for r in wanted.select("contig").distinct().limit(MAX_PUSHED_CONTIGS + 1).collect()]
        contigs = names if 0 < len(names) <= MAX_PUSHED_CONTIGS else None
    lines = read_vcf_lines(spark, paths, contigs=contigs)
    # One projection over the lines (a union of a header branch and a record branch would
    # scan and decompress the text twice).
    is_head = F.col("value").startswith("#")
    kept = lines.where(F.when(is_head, F.col("value").rlike(KEPT_HEADERS)).otherwise(F.length("value") > 0))
    # The fixed fields; the ninth is FORMAT with all sample columns, in one piece.
    kept = kept.select("file", F.when(is_head, F.col("value")).alias("value"), F.when(~is_head, F.split("value", "\t", 9)).alias("_f"))
    fixed = dict(site_columns(F.col("_f")))
    if normalize:
        fixed["contig"] = normalize_contig(fixed["contig"])
    kept = kept.select("file", "value", *[fixed[c].alias(c) for c in ("contig", "pos", "end", "ref", "alts")], F.get("_f", 8).alias("_rest"))
    if wanted is not None:
        kept = records_in_regions(kept, wanted, or_where=F.col("value").isNotNull())
    text_format = F.split(F.substring_index("_rest", "\t", 1), ":")
    fields = F.split("_rest", "\t")
    calls = F.when(F.size(fields) > 1, F.slice(fields, 2, F.size(fields) - 1)).otherwise(F.array().cast("array<string>"))
    named = F.filter(text_format, lambda k: k.isin(*FORMAT_KEYS))
    places = F.transform(named, lambda k: F.array_position(text_format, k).cast("int") - 1)
    slim = F.transform(calls, lambda c: F.array_join(F.transform(places, lambda i: F.coalesce(F.get(F.split(c, ":"), i), F.lit("."))), ":"))
    calls = F.when(F.size(named) == F.size(text_format), calls).otherwise(slim)
    is_record = F.col("value").isNull()
    part = F.when(~is_record, HEADER).when(F.col("contig") == INFERENCE_CONTIG, CHRX).otherwise(OTHER)
    table = kept.select(
        "file", part.alias("part"), *[F.when(is_record, F.col(c)).alias(c) for c in ("contig", "pos", "end", "ref", "alts")],
        F.when(is_record, named).alias("format"), F.when(is_record, F.coalesce(calls, F.array().cast("array<string>"))).alias("calls"), "value",
    )
    table.write.mode("overwrite").partitionBy("part").parquet(path)
    table = spark.read.parquet(path)
    headers = table.where(F.col("part") == HEADER).select("file", "value")
    records = table.where(F.col("part") != HEADER).drop("value")
    return with_float_keys(records, header_float_keys(headers)), headers


def run_count(
    spark: SparkSession,
    paths: list[str],
    out_dir: str,
    regions: list[str] | str | None = None,
    filters: Filters = Filters(),
    keep_pile: bool = False,
) -> None:
    """The 'count' step: VCF files -> a version of the dataset in ``out_dir`` (info.json, samples, counts, reports and,
    with ``keep_pile``, pile). It replaces the former version once it is whole."""
    tune(spark)
    scratch, reg = scratch_path(spark, f"vcf-{uuid.uuid4().hex}"), regions_frame(spark, regions)

    def write(folder: str) -> None:
        sites, headers = ingest_vcf(spark, paths, scratch, reg, filters.normalize_contigs)
        names = headers.where(F.col("value").startswith("#CHROM")).select("file").distinct()
        missing = missing_contigs(reg, header_contigs(headers), names)
        inputs = names.select("file", file_label("file").alias("label"), is_supported_name("file").alias("known_extension"))
        missing.write.parquet(f"{folder}/reports/missing_contigs")
        inputs.write.parquet(f"{folder}/reports/inputs")
        ds = count_sites(sites, reliable_checkpoint(header_samples(headers)), reg, filters)
        tables.write_counts(spark, folder, ds.samples, ds.info, ds.counts)
        if keep_pile:
            tables.write_pile(pile_for_sites(sites, ds.samples, reg, filters), f"{folder}/pile")

    try:
        tables.write_version(spark, out_dir, write)
    finally:
        remove_path(spark, scratch)
    reports = tables.part(spark, out_dir, "reports")
    n_missing = spark.read.parquet(f"{reports}/missing_contigs").count()
    n_silent = tables.read_samples(spark, out_dir).where("n_hom + n_het = 0").count()
    if n_missing:
        log.warning("%d regions lie on contigs that some file headers lack: %s/missing_contigs", n_missing, reports)
    if n_silent:
        log.warning("%d samples have no chrX calls to infer their sex from (taken as XX): %s", n_silent, out_dir)
    log.info("count written to %s", out_dir)


def run_finalize(spark: SparkSession, in_dir: str, out_dir: str) -> None:
    """The 'finalize' step: AN, DP mean/std per variant, variants without counted alleles dropped."""
    tune(spark)
    if in_dir.rstrip("/") == out_dir.rstrip("/"):
        raise ValueError("the result would replace the counts it is made from; give it a folder of its own")
    info = tables.read_dataset_info(spark, in_dir)
    result = finalize(tables.read_counts(spark, in_dir), info)
    tables.write_result(result, info, out_dir)


def run_merge(spark: SparkSession, in_dirs: list[str], out_dir: str) -> None:
    """Merge count datasets of several centers into one count dataset (re-summed): one scan over all."""
    tune(spark)
    _each_once(in_dirs)
    counts, info = merge_counts(tables.read_counts(spark, *in_dirs)), merge_info(tables.read_dataset_info(spark, *in_dirs))
    tables.write_count_dataset(tables.read_samples(spark, *in_dirs), info, counts, out_dir)


def run_merge_add(spark: SparkSession, merged_dir: str, in_dirs: list[str]) -> None:
    """Add centers to a merged dataset: only the regions that they hold are summed and written again, the
    others stay where they are."""
    tune(spark)
    _each_once([merged_dir, *in_dirs])
    old, new = tables.manifest(spark, merged_dir), tables.read_counts(spark, *in_dirs)
    touched = tables.manifest(spark, *in_dirs).select("region").distinct()
    others = reliable_checkpoint(old.join(touched, "region", "left_anti"))
    counts = added_counts(tables.read_counts(spark, merged_dir), new)
    info = merge_info(tables.read_dataset_info(spark, merged_dir, *in_dirs))
    samples = tables.read_samples(spark, merged_dir, *in_dirs)

    def write(folder: str) -> set[str]:
        tables.write_counts(spark, folder, samples, info, counts, others=others)
        return {r.holder for r in others.select("holder").distinct().collect()}

    tables.write_version(spark, merged_dir, write)


def _each_once(dirs: list[str]) -> None:
    if len({d.rstrip("/") for d in dirs}) < len(dirs):
        raise ValueError("a count dataset is named twice")
