"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over the whole test tables.

The genotype calls come from ``sources.projection`` (lineitem joined to orders); every
query exercises one operator of the library on them. Doubles are rounded to 6 places so
that the DuckDB oracle in ``cohortac.oracle_queries`` can be compared value by value.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.constants import PILE_COLUMNS
from cohortac.functions.genome import par_class
from cohortac.functions.genotype import allelic_balance, gt_class, het_allele_indices, parse_gt, parse_int
from cohortac.functions.regions import begin0, format_region, invalid_reason, parse_region, regions_frame, split_region_list
from cohortac.operators.counts import depth_distribution, depth_moments, sorted_counts
from cohortac.operators.finalize import allele_number_columns, depth_mean, depth_std, finalize, nonzero_variants, with_sample_number
from cohortac.operators.merge import merge_counts, merge_info
from cohortac.operators.pile import (
    chry_filter,
    dp_outcome,
    drop_gvcf_blocks,
    drop_spanning_deletion,
    explode_alleles,
    gq_pass,
    join_sample_sex,
    missing_dp_filter,
)
from cohortac.operators.regions import missing_contigs, region_interval_join, region_overlap_scan
from cohortac.operators.sampling import cap_per_contig, subsample_per_contig
from cohortac.operators.sex import dataset_info
from cohortac.plans import jobs
from cohortac.plans.pipeline import count_dataset, count_sites, pile_for, samples_sex
from cohortac.session import reliable_checkpoint, scratch_path, tune
from cohortac.sources import tables
from cohortac.sources.bgzf import make_header_files, write_bgzf_parts
from cohortac.sources.projection import genotypes_from_tables
from cohortac.sources.vcf import (
    call_fields,
    explode_samples,
    file_label,
    header_contigs,
    header_samples,
    input_files,
    is_supported_name,
    parse_sites,
    read_vcf_lines,
    to_vcf_lines,
    write_vcf_parts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

KEYS = ["l_orderkey", "l_linenumber"]
# Regions of the interval-join query (two overlapping, open-ended, single-position).
JOIN_REGIONS = ["chr1:1-7000", "chr1:5000-14000", "chrX", "chrY:2781480", "chrM:100-200", "chr20:13994"]


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__.removeprefix("q_")] = run
    return run


def _r6(c, name=None):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col, 6).alias(name or c)


def _g(spark, sf_dir) -> DataFrame:
    return genotypes_from_tables(spark, sf_dir, keep_keys=True)


def _gm(spark, sf_dir) -> DataFrame:
    """The projected calls written once to the shared folder, for plans that read them twice
    (sex inference and the pile), as the count job does with its ingested VCF table."""
    return reliable_checkpoint(_g(spark, sf_dir))


def _calls(spark, sf_dir):
    """Calls that reach classification (default regions, gVCF, sex, chrY and DP rules)."""
    g = _gm(spark, sf_dir)
    s = samples_sex(g)
    c = region_interval_join(g, regions_frame(spark, None))
    c = join_sample_sex(drop_gvcf_blocks(c), s)
    return missing_dp_filter(chry_filter(c))


def _alleles(spark, sf_dir):
    return explode_alleles(_calls(spark, sf_dir))


def _dataset(spark, sf_dir, **kw):
    return count_dataset(_gm(spark, sf_dir), **kw)


def _vcf_lines(spark, sf_dir, in_order=False):
    return to_vcf_lines(genotypes_from_tables(spark, sf_dir), in_order=in_order)


LIST_TEXTS = 500


def _region_texts(spark, sf_dir):
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size", "p_brand")
    pk = F.col("p_partkey")
    contig = F.element_at(F.array(*[F.lit(c) for c in ["chr1", "chr20", "chrX", "chrY", "chrM"]]), (pk % 5 + 1).cast("int"))
    pos = ((pk * 9973) % 2000 * 7 + 1).cast("long")
    last = pos + F.col("p_size")
    kind = pk % 6
    text = (
        F.when(kind == 0, contig)
        .when(kind == 1, F.concat(contig, F.lit(":"), pos.cast("string")))
        .when(kind == 2, F.concat(contig, F.lit(":"), pos.cast("string"), F.lit("-"), last.cast("string")))
        .when(kind == 3, F.concat(contig, F.lit(":"), F.lpad(pos.cast("string"), 9, "0"), F.lit("-"), last.cast("string")))
        .when(kind == 4, F.concat(contig, F.lit(":"), last.cast("string"), F.lit("-"), pos.cast("string")))
        .when(pk % 12 == 5, F.concat(contig, F.lit(":99999999999999999999")))
        .otherwise(F.col("p_brand"))
    )
    return p.select("p_partkey", text.alias("text"))


# ------------------------------------------------------------------ flagship chain
@query
def q_finalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = _dataset(spark, sf_dir)
    res = finalize(ds.counts, ds.info)
    return res.select(*[c for c in res.columns if c not in ("DP_mean", "DP_std")], _r6("DP_mean"), _r6("DP_std"))


@query
def q_allele_counts(spark, sf_dir):
    return _dataset(spark, sf_dir).counts


@query
def q_infer_sex(spark, sf_dir):
    return samples_sex(_g(spark, sf_dir))


@query
def q_dataset_info(spark, sf_dir):
    info = dataset_info(samples_sex(_g(spark, sf_dir)), 10, 20, 0.2)
    return info.select(
        "version",
        F.col("sample_number.XX").alias("XX"),
        F.col("sample_number.XY").alias("XY"),
        F.col("AC0_filter.min_DP").alias("min_DP"),
        F.col("AC0_filter.min_GQ").alias("min_GQ"),
        F.col("AC0_filter.min_AB").alias("min_AB"),
    )


# ------------------------------------------------------------------ filters
@query
def q_drop_gvcf_blocks(spark, sf_dir):
    g = drop_gvcf_blocks(_g(spark, sf_dir))
    return g.select("file", "sample_rank", "contig", "pos", "ref", F.get("alts", 0).alias("alt0"), F.get("alts", 1).alias("alt1"), *KEYS)


@query
def q_explode_alleles(spark, sf_dir):
    a = _alleles(spark, sf_dir)
    return a.select("file", "sample_rank", "contig", "pos", "ref", "alt", "ac", "ac_hom", "ac_hemi", "passed", *KEYS)


@query
def q_drop_spanning_deletion(spark, sf_dir):
    a = drop_spanning_deletion(_alleles(spark, sf_dir))
    return a.select("file", "sample_rank", "contig", "pos", "ref", "alt", "ac", "ac_hom", "ac_hemi", "passed", *KEYS)


@query
def q_missing_dp_filter(spark, sf_dir):
    g = _g(spark, sf_dir)
    g = g.withColumn("dp", parse_int(F.coalesce(F.col("dp").cast("string"), F.lit("."))))
    return missing_dp_filter(g).select("file", "sample_rank", "contig", "pos", "dp", *KEYS)


@query
def q_gq_pass(spark, sf_dir):
    g = _g(spark, sf_dir)
    return g.select("file", "sample_rank", "contig", "pos", "gq", gq_pass(20).alias("gq_pass"), *KEYS)


@query
def q_ab_pass(spark, sf_dir):
    c = _calls(spark, sf_dir)
    e = c.select("file", "sample_rank", "contig", "pos", "dp", "ad", *KEYS, F.explode(het_allele_indices("gt")).alias("allele"))
    ab = allelic_balance("ad", "dp", F.col("allele"))
    return e.select("file", "sample_rank", "contig", "pos", "allele", _r6(ab, "ab"), (ab > F.lit(0.2)).alias("ab_pass"), *KEYS)


@query
def q_dp_outcome(spark, sf_dir):
    a = drop_spanning_deletion(_alleles(spark, sf_dir))
    ac, hom, hemi, flag = dp_outcome(10)
    return a.select(
        "file", "sample_rank", "contig", "pos", "alt",
        ac.alias("AC"), hom.alias("AC_hom"), hemi.alias("AC_hemi"), flag.alias("n_DP_discarded"), *KEYS,
    )


@query
def q_chry_filter(spark, sf_dir):
    g = _gm(spark, sf_dir)
    c = chry_filter(join_sample_sex(g, samples_sex(g)))
    return c.select("file", "sample_rank", "contig", "pos", "sex", *KEYS)


@query
def q_par_classify(spark, sf_dir):
    g = _g(spark, sf_dir).select("contig", "pos").distinct()
    return g.select("contig", "pos", par_class("contig", "pos").alias("par_class"))


@query
def q_nonzero_variants(spark, sf_dir):
    return nonzero_variants(_dataset(spark, sf_dir).counts)


@query
def q_inspect_filter(spark, sf_dir):
    return tables.inspect(_dataset(spark, sf_dir).counts, "XX_AC > 5 AND DP_sum > 100")


# ------------------------------------------------------------------ genotype transforms
@query
def q_gt_classify(spark, sf_dir):
    g = _g(spark, sf_dir)
    return g.select("file", "sample_rank", "contig", "pos", gt_class("gt").alias("gt_class"), *KEYS)


@query
def q_allele_count_triple(spark, sf_dir):
    a = _alleles(spark, sf_dir).where(~F.col("hemi"))
    return a.select("file", "sample_rank", "contig", "pos", "alt", "ac", "ac_hom", "ac_hemi", *KEYS)


@query
def q_hemizygous_counts(spark, sf_dir):
    a = _alleles(spark, sf_dir).where(F.col("hemi"))
    return a.select("file", "sample_rank", "contig", "pos", "alt", "ac", "ac_hom", "ac_hemi", *KEYS)


@query
def q_allelic_balance(spark, sf_dir):
    c = _calls(spark, sf_dir)
    return c.select(
        "file", "sample_rank", "contig", "pos",
        _r6(allelic_balance("ad", "dp", F.lit(1)), "ab1"),
        _r6(allelic_balance("ad", "dp", F.lit(2)), "ab2"),
        *KEYS,
    )


@query
def q_join_sample_sex(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return join_sample_sex(g, samples_sex(g)).select("file", "sample_rank", "sample", "contig", "pos", "sex", *KEYS)


@query
def q_sex_split_pile(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return pile_for(g, samples_sex(g), keep=("file", "sample_rank", "sex", "l_orderkey", "l_linenumber"))


@query
def q_build_pile(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return pile_for(g, samples_sex(g)).select(*PILE_COLUMNS)


# ------------------------------------------------------------------ aggregates
@query
def q_union_piles(spark, sf_dir):
    """Every file's pile written as a table of its own, all of them read in one scan."""
    g = _gm(spark, sf_dir)
    path = scratch_path(spark, f"piles_{uuid.uuid4().hex}")
    tables.write_pile(pile_for(g, samples_sex(g), keep=("file",)), path, by=("file",))
    return tables.read_pile(spark, path, by=("file",))


@query
def q_depth_moments(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return depth_moments(pile_for(g, samples_sex(g)))


@query
def q_depth_list(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return depth_distribution(pile_for(g, samples_sex(g)))


@query
def q_allele_number(spark, sf_dir):
    ds = _dataset(spark, sf_dir)
    c = with_sample_number(nonzero_variants(ds.counts), ds.info)
    return c.select("region", "contig", "pos", "ref", "alt", *allele_number_columns())


@query
def q_depth_mean_std(spark, sf_dir):
    c = _dataset(spark, sf_dir).counts
    return c.select("region", "contig", "pos", "ref", "alt", _r6(depth_mean(), "DP_mean"), _r6(depth_std(), "DP_std"))


@query
def q_sorted_counts(spark, sf_dir):
    return sorted_counts(_dataset(spark, sf_dir).counts)


@query
def q_merge_centers(spark, sf_dir):
    ds = count_dataset(_gm(spark, sf_dir), by=("file",))  # every file a center
    counts, info = merge_counts(ds.counts), merge_info(ds.info)
    res = finalize(counts, info)
    return res.select(*[c for c in res.columns if c not in ("DP_mean", "DP_std")], _r6("DP_mean"), _r6("DP_std"))


# ------------------------------------------------------------------ regions
@query
def q_parse_regions(spark, sf_dir):
    t = _region_texts(spark, sf_dir)
    r = t.select("text", parse_region("text").alias("r"))
    return r.select("text", "r.contig", "r.begin", "r.end", "r.is_valid")


@query
def q_validate_regions(spark, sf_dir):
    r = _region_texts(spark, sf_dir)
    return r.select("text", parse_region("text")["is_valid"].alias("is_valid"), invalid_reason("text").alias("reason"))


def _region_lists(texts):
    """Comma lists of about ``LIST_TEXTS`` texts, dealt by a hash of the part key; equal texts spread too."""
    lists = max(1, -(-texts.count() // LIST_TEXTS))
    dealt = texts.groupBy(F.pmod(F.xxhash64("p_partkey"), F.lit(lists)))
    return dealt.agg(F.array_join(F.collect_list("text"), ",").alias("list"))


@query
def q_split_region_list(spark, sf_dir):
    """Region texts gathered into comma lists of bounded length and taken apart again."""
    lists = _region_lists(_region_texts(spark, sf_dir))
    return lists.select(F.explode(split_region_list("list")).alias("text")).groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query
def q_format_regions(spark, sf_dir):
    r = _region_texts(spark, sf_dir).select("text", parse_region("text").alias("r")).where(F.col("r.is_valid"))
    return r.select("text", format_region("r.contig", "r.begin", "r.end").alias("region"), begin0("r.begin").alias("begin0"))


@query
def q_default_regions(spark, sf_dir):
    regions = regions_frame(spark, None)
    n = region_interval_join(_g(spark, sf_dir), regions).groupBy("region").agg(F.count(F.lit(1)).alias("n_calls"))
    return regions.join(n, "region", "left").select("region", "contig", F.coalesce("n_calls", F.lit(0)).alias("n_calls"))


@query
def q_region_overlap_scan(spark, sf_dir):
    r = region_overlap_scan(_g(spark, sf_dir), "chr20", 5000, 9000)
    return r.select("file", "sample_rank", "contig", "pos", "end", *KEYS)


@query
def q_region_interval_join(spark, sf_dir):
    r = region_interval_join(_g(spark, sf_dir), regions_frame(spark, JOIN_REGIONS))
    return r.select("region", "file", "sample_rank", "contig", "pos", "end", *KEYS)


@query
def q_missing_contigs(spark, sf_dir):
    lines = _vcf_lines(spark, sf_dir)
    files = lines.where(F.col("value").startswith("#CHROM")).select("file")
    return missing_contigs(regions_frame(spark, None), header_contigs(lines), files)


# ------------------------------------------------------------------ VCF text ingest
def _file_names(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_nationkey")
    ext = F.element_at(
        F.array(*[F.lit(e) for e in [".vcf.gz", ".vcf.bgz", ".bcf", ".vcf", ".txt.gz"]]), (F.col("c_custkey") % 5 + 1).cast("int")
    )
    path = F.concat(F.lit("dir"), F.col("c_nationkey").cast("string"), F.lit("/c"), F.col("c_custkey").cast("string"), ext)
    return c.select(path.alias("path"))


@query
def q_file_label(spark, sf_dir):
    f = _file_names(spark, sf_dir)
    return f.select("path", file_label("path").alias("label"), is_supported_name("path").alias("supported"))


@query
def q_vcf_parse_sites(spark, sf_dir):
    s = parse_sites(_vcf_lines(spark, sf_dir))
    return s.select(
        "file", "contig", "pos", "end", "ref",
        F.size("alts").alias("n_alts"), F.get("alts", 0).alias("alt0"), F.get("alts", 1).alias("alt1"),
        F.array_join("format", ":").alias("format"), F.size("calls").alias("n_calls"),
    )


@query
def q_vcf_header_samples(spark, sf_dir):
    return header_samples(_vcf_lines(spark, sf_dir))


@query
def q_explode_samples(spark, sf_dir):
    e = explode_samples(parse_sites(_vcf_lines(spark, sf_dir)))
    return e.select("file", "contig", "pos", "end", "ref", "sample_rank", "call")


@query
def q_format_lookup(spark, sf_dir):
    f = call_fields(explode_samples(parse_sites(_vcf_lines(spark, sf_dir))))
    return f.select(
        "file", "contig", "pos", "sample_rank", "gt_text", "dp_text", "gq_text", "ad_text",
        parse_int("dp_text").alias("dp"), parse_int("gq_text").alias("gq"),
    )


@query
def q_gt_parse(spark, sf_dir):
    f = call_fields(explode_samples(parse_sites(_vcf_lines(spark, sf_dir))))
    gt = parse_gt("gt_text", F.size("alts"))
    return f.select(
        "file", "contig", "pos", "sample_rank", "gt_text",
        F.size(gt).alias("ploidy"), F.get(gt, 0).alias("g0"), F.get(gt, 1).alias("g1"),
        F.col("gt_text").contains("|").alias("phased"),
    )


@query
def q_vcf_count_roundtrip(spark, sf_dir):
    # the text is produced once and read from the shared folder, as the count job's ingest does
    lines = reliable_checkpoint(_vcf_lines(spark, sf_dir))
    ds = count_sites(parse_sites(lines), header_samples(lines))
    res = finalize(ds.counts, ds.info)
    return res.select(*[c for c in res.columns if c not in ("DP_mean", "DP_std")], _r6("DP_mean"), _r6("DP_std"))


@query
def q_pile_tsv_scan(spark, sf_dir):
    g = _gm(spark, sf_dir)
    pile = pile_for(g, samples_sex(g))
    path = scratch_path(spark, f"pile_tsv_{uuid.uuid4().hex}")
    tables.write_pile(pile, path, fmt="tsv")
    return tables.read_pile_tsv(spark, path)


# ------------------------------------------------------------------ tables written and read again
def _pile(spark, sf_dir):
    g = _gm(spark, sf_dir)
    return pile_for(g, samples_sex(g))


def _vcf_folder(spark, sf_dir) -> str:
    """The projected calls as one text file per center, written in parts to the shared scratch."""
    path = scratch_path(spark, f"vcf_text_{uuid.uuid4().hex}")
    write_vcf_parts(_vcf_lines(spark, sf_dir, in_order=True), path, in_order=True)
    return path


def _count_job(spark, sf_dir, **kw) -> str:
    """The count job run on VCF files; the folder it wrote."""
    out = scratch_path(spark, f"count_{uuid.uuid4().hex}")
    jobs.run_count(spark, [_vcf_folder(spark, sf_dir)], out, **kw)
    return out


@query
def q_pile_parquet_sink(spark, sf_dir):
    path = scratch_path(spark, f"pile_{uuid.uuid4().hex}")
    tables.write_pile(_pile(spark, sf_dir), path)
    return tables.read_pile(spark, path)


@query
def q_multi_file_scan(spark, sf_dir):
    """Counts written as one table per contig and scanned together by a glob pattern."""
    path = scratch_path(spark, f"parts_{uuid.uuid4().hex}")
    counts = _dataset(spark, sf_dir).counts
    counts.withColumn("part", F.col("contig")).write.partitionBy("part").parquet(path)
    return tables.read_count_files(spark, f"{path}/*/*.parquet")


@query
def q_count_job(spark, sf_dir):
    return tables.read_counts(spark, _count_job(spark, sf_dir))


@query
def q_count_job_overwrite(spark, sf_dir):
    """A second count into the same folder leaves nothing of the first one."""
    vcf, out = _vcf_folder(spark, sf_dir), scratch_path(spark, f"count_{uuid.uuid4().hex}")
    jobs.run_count(spark, [vcf], out, regions="chr1:1-5000,chr2", keep_pile=True)
    jobs.run_count(spark, [vcf], out)
    left = 1 if tables.exists(spark, tables.part(spark, out, "pile")) else 0
    return tables.read_counts(spark, out).withColumn("kept_piles", F.lit(left))


@query
def q_count_job_pile(spark, sf_dir):
    out = _count_job(spark, sf_dir, keep_pile=True)
    return tables.read_pile(spark, tables.part(spark, out, "pile"))


@query
def q_list_regions(spark, sf_dir):
    return tables.list_regions(spark, _count_job(spark, sf_dir))


@query
def q_info_roundtrip(spark, sf_dir):
    """Dataset metadata written as JSON by the count job and read again."""
    info = tables.read_dataset_info(spark, _count_job(spark, sf_dir))
    return info.select(
        "version",
        F.col("sample_number.XX").alias("XX"),
        F.col("sample_number.XY").alias("XY"),
        F.col("AC0_filter.min_DP").alias("min_DP"),
        F.col("AC0_filter.min_GQ").alias("min_GQ"),
        F.col("AC0_filter.min_AB").alias("min_AB"),
    )


@query
def q_result_sink(spark, sf_dir):
    """count and finalize as write jobs; the result table read again."""
    out = scratch_path(spark, f"result_{uuid.uuid4().hex}")
    jobs.run_finalize(spark, _count_job(spark, sf_dir), out)
    res = tables.read_result(spark, out)
    return res.select(*[c for c in res.columns if c not in ("DP_mean", "DP_std")], _r6("DP_mean"), _r6("DP_std"))


@query
def q_bgzf_scan(spark, sf_dir):
    """The VCF text written as BGZF files in parts and read in small splits."""
    path = scratch_path(spark, f"bgzf_{uuid.uuid4().hex}")
    write_bgzf_parts(_vcf_lines(spark, sf_dir, in_order=True), path).count()
    lines = read_vcf_lines(spark, [path], split_bytes=100_000)
    s = parse_sites(lines.withColumn("file", F.regexp_extract("file", "([^/]*)$", 1)))
    return s.select(
        "file", "contig", "pos", "end", "ref",
        F.size("alts").alias("n_alts"), F.get("alts", 0).alias("alt0"), F.get("alts", 1).alias("alt1"),
        F.array_join("format", ":").alias("format"), F.size("calls").alias("n_calls"),
    )


@query
def q_file_select(spark, sf_dir):
    """Input expansion over real folders: files named after customers, listed by the engine."""
    path = scratch_path(spark, f"names_{uuid.uuid4().hex}")
    names = _file_names(spark, sf_dir).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"))
    make_header_files(names, path).count()
    return input_files(spark, [f"{path}/*"]).select(F.regexp_extract("path", "([^/]*)$", 1).alias("name"), file_label("path").alias("label"))


# ------------------------------------------------------------------ sampling
def _records(spark, sf_dir):
    return _g(spark, sf_dir).select("file", "sample_rank", "contig", "pos", "l_orderkey", "l_partkey", "l_linenumber")


@query
def q_subsample_per_contig(spark, sf_dir):
    key = (F.col("l_orderkey") * 7919 + F.col("l_partkey") + F.col("replica") * 104729) % 1000003
    return subsample_per_contig(_records(spark, sf_dir), replicas=2, fraction=0.25, min_size=5, order_key=key, sort_output=True)


@query
def q_cap_per_contig(spark, sf_dir):
    tie = (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey")) % 2147483647
    return cap_per_contig(_records(spark, sf_dir), cap=1000, tie_key=tie)


# ------------------------------------------------------------------ streaming
@query
def q_streaming_counts(spark, sf_dir):
    """lineitem as a file stream -> typed calls per batch -> counts over all batches -> finalize."""
    from cohortac.streaming.counts import ingest_batches, running_counts

    schema = spark.read.parquet(f"{sf_dir}/lineitem.parquet").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/lineitem*.parquet")
    run = uuid.uuid4().hex
    out, ckpt = scratch_path(spark, f"stream-{run}"), scratch_path(spark, f"stream-ckpt-{run}")
    q = ingest_batches(stream, lambda b: genotypes_from_tables(b.sparkSession, sf_dir, lineitem=b), out, ckpt)
    q.awaitTermination()
    ds = running_counts(spark, out, with_headers=False)
    res = finalize(ds.counts, ds.info)
    return res.select(*[c for c in res.columns if c not in ("DP_mean", "DP_std")], _r6("DP_mean"), _r6("DP_std"))
