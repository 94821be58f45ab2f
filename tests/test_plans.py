"""Plan shapes that matter at scale: pushdown, pruning, partial aggregation, no cross joins."""

from cohortac.operators.finalize import finalize
from cohortac.operators.sex import inference_window
from cohortac.plans.pipeline import count_dataset
from cohortac.session import reliable_checkpoint
from cohortac.sources import tables
from cohortac.sources.projection import genotypes_from_tables
from cohortac.sources.vcf import header_samples, sites_to_genotypes
from helpers import SF001


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_count_plan(spark):
    g = reliable_checkpoint(genotypes_from_tables(spark, SF001))  # a Parquet genotype table
    ds = count_dataset(g)
    p = plan(ds.counts)
    assert "BroadcastNestedLoopJoin" not in p and "Cartesian" not in p and "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") == 2  # regions, samples
    assert "partial_sum" in p  # map-side combine before the single shuffle
    assert "IsNotNull(dp)" in p  # the missing-DP rule reaches the Parquet scan
    scan = [ln for ln in p.split("\n") if "FileScan parquet" in ln and "dp#" in ln][0]
    read_cols = scan.split("FileScan parquet [")[1].split("]")[0]
    assert "sample#" not in read_cols and "phased#" not in read_cols  # unused columns are pruned


def test_finalize_plan_is_map_only(spark, tmp_path):
    g = reliable_checkpoint(genotypes_from_tables(spark, SF001))
    ds = count_dataset(g)
    out = str(tmp_path / "ds")
    tables.write_count_dataset(ds.samples, ds.info, ds.counts, out)
    res = finalize(tables.read_counts(spark, out), tables.read_dataset_info(spark, out))
    p = plan(res)
    main = p.split("Subquery")[0]
    assert "Exchange" not in main and "Join" not in main
    assert "Or(GreaterThan(XX_AC,0),GreaterThan(XY_AC,0))" in p  # P11 pushed to the scan


def test_sex_inference_prunes_to_chrx(spark, tmp_path):
    import gzip

    from cohortac.operators.sex import infer_sex
    from cohortac.plans.jobs import ingest_vcf
    from helpers import vcf_text

    body = "chrX 3000000 . A C . . . GT:DP 0/1:20\nchr1 100 . A C . . . GT:DP 1/1:20"
    p = tmp_path / "a.vcf.gz"
    p.write_bytes(gzip.compress(vcf_text(body, ["S1"], ["chr1", "chrX"]).encode()))
    sites, headers = ingest_vcf(spark, [str(p)], str(tmp_path / "table"))
    text = plan(infer_sex(sites_to_genotypes(inference_window(sites.where("part = 'chrX'"))), header_samples(headers)))
    scan = [line for line in text.split("\n") if "PartitionFilters" in line and "calls#" in line][0]
    assert "(part#" in scan and "= chrX)" in scan


def test_records_are_settled_before_samples_are_exploded(spark, tmp_path):
    """Region join, reference blocks, no-ALT rule and sample sexes work per record; no join has a row per call."""
    from cohortac.plans.jobs import ingest_vcf
    from cohortac.plans.pipeline import pile_for_sites
    from helpers import vcf_text

    body = "chr1 100 . A C . . . GT:DP:GQ 1/1:20:50 0/1:30:50\nchr2 100 . A . . . . GT:DP 0/0:20 0/0:20"
    p = tmp_path / "a.vcf"
    p.write_text(vcf_text(body, ["S1", "S2"], ["chr1", "chr2"]))
    sites, _ = ingest_vcf(spark, [str(p)], str(tmp_path / "table"))
    samples = spark.createDataFrame([(r.file, k, "XX") for r in sites.select("file").distinct().collect() for k in (0, 1)], "file string, sample_rank int, sex string")
    pile = pile_for_sites(sites, samples, "chr1:1-1000")
    assert sorted((r.alt, r.XX_AC) for r in pile.collect()) == [("C", 0), ("C", 2)]  # no error from chr2
    text = plan(pile)
    assert text.index("posexplode") < text.index("BroadcastHashJoin")  # the tree prints parents first
    assert "sample_rank#" not in "".join(line for line in text.split("\n") if "Join" in line)
    import pytest

    with pytest.raises(Exception, match="Record without ALT at chr2:100"):
        pile_for_sites(sites, samples, "chr1,chr2").collect()


def test_many_regions_make_a_small_plan(spark):
    from cohortac.functions.regions import regions_frame
    from cohortac.operators.regions import region_interval_join

    texts = [f"chr{i % 22 + 1}:{i * 100 + 1}-{i * 100 + 60}" for i in range(200_000)]
    frame = regions_frame(spark, texts)
    records = spark.createDataFrame([("chr1", 1, 10), ("chr2", 161, 400)], "contig string, pos int, end int")
    joined = region_interval_join(records, frame)
    assert "BroadcastHashJoin" in plan(joined)
    assert sorted(r.region for r in joined.collect()) == ["chr1:1-60"]
