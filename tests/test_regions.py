"""Region text handling and overlap semantics."""

import pytest
from pyspark.sql import functions as F

from cohortac.functions.regions import parse_region, regions_frame
from cohortac.operators.regions import missing_contigs, region_interval_join, region_overlap_scan
from cohortac.queries import _region_lists
from helpers import geno


def parsed(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [tuple(r.r) for r in df.select(parse_region("t").alias("r")).collect()]


def test_parse(spark):
    assert parsed(spark, ["chr3", "chr2:150", "chr1:100-200"]) == [
        ("chr3", None, None, True),
        ("chr2", 150, None, True),
        ("chr1", 100, 200, True),
    ]
    bad = parsed(spark, ["chr1:200-100", "chr1:", "chr-1", "chr1:1-2-3", "", "chr1.5"])
    assert [b[3] for b in bad] == [False] * 6


def test_regions_frame_strict_and_dedup(spark):
    r = regions_frame(spark, "chr1:0100-200,chr1:100-200,chrX")
    assert sorted(x.region for x in r.collect()) == ["chr1:100-200", "chrX"]
    with pytest.raises(Exception, match="Invalid region"):
        regions_frame(spark, ["chr1:5-1"]).collect()
    assert regions_frame(spark, ["chr1:5-1", "chr2"], strict=False).count() == 1
    assert regions_frame(spark, None).count() == 25


def test_overlap_includes_records_starting_before(spark):
    g = geno(spark, [dict(pos=90, end=120), dict(pos=80, end=99), dict(pos=200, end=200), dict(pos=201, end=250)])
    got = sorted(r.pos for r in region_overlap_scan(g, "chr1", 100, 200).collect())
    assert got == [90, 200]


def test_interval_join_duplicates_into_overlapping_regions(spark):
    g = geno(spark, [dict(pos=150), dict(pos=5), dict(contig="chr2", pos=1)])
    r = regions_frame(spark, ["chr1:100-200", "chr1:150", "chr1", "chr3"])
    got = sorted((x.region, x.pos) for x in region_interval_join(g, r).collect())
    assert got == [("chr1", 5), ("chr1", 150), ("chr1:100-200", 150), ("chr1:150", 150)]


def test_missing_contigs(spark):
    fc = spark.createDataFrame([("a", "chr1"), ("b", "chr1"), ("b", "chr2")], "file string, contig string")
    r = regions_frame(spark, ["chr1", "chr2:5-10", "chr3"])
    got = sorted(tuple(x) for x in missing_contigs(r, fc).collect())
    assert got == [("chr2:5-10", "chr2", 1), ("chr3", "chr3", 2)]


def test_region_lists_are_bounded(spark):
    texts = spark.range(20_000).selectExpr("id AS p_partkey", "concat('chr', id % 3) AS text")
    sizes = [r[0] for r in _region_lists(texts).select(F.size(F.split("list", ","))).collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 1000
