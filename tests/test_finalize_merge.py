"""Finalize formulas, cross-center merge invariants, partition independence."""

import pytest
from pyspark.sql import functions as F

from cohortac.operators.finalize import finalize
from cohortac.operators.merge import merge_counts, merge_info
from cohortac.operators.sex import dataset_info
from cohortac.plans.pipeline import count_dataset
from cohortac.sources.projection import genotypes_from_tables
from helpers import SF001

COUNTS_DDL = (
    "region string, contig string, pos int, ref string, alt string, XX_AC int, XX_AC_hom int, XX_AC_hemi int, "
    "XY_AC int, XY_AC_hom int, XY_AC_hemi int, XX_n_DP_discarded int, XY_n_DP_discarded int, n_samples int, "
    "DP_sum double, DP2_sum double"
)


def info(spark, xx, xy, dp=10, gq=20, ab=0.2):
    s = spark.createDataFrame([("f", i, f"s{i}", 0, 0, "XX") for i in range(xx)] + [("f", 100 + i, f"t{i}", 0, 0, "XY") for i in range(xy)],
                              "file string, sample_rank int, sample string, n_hom long, n_het long, sex string")
    return dataset_info(s, dp, gq, ab)


def test_depth_mean_std_golden(spark):
    dps = [41, 41, 55]
    c = spark.createDataFrame(
        [("chr1", "chr1", 271075, "G", "A", 4, 1, 0, 0, 0, 0, 0, 0, 3, float(sum(dps)), float(sum(d * d for d in dps)))], COUNTS_DDL
    )
    r = finalize(c, info(spark, 4, 0)).first()
    assert r.DP_mean == 45.666666666666664
    assert r.DP_std == 6.599663291074451
    assert (r.XX_AN, r.XY_AN) == (8, 0)


def test_allele_number_ploidy(spark):
    rows = [
        ("chrM", "chrM", 10, "A", "C", 1, 0, 0, 1, 0, 0, 1, 0, 3, 30.0, 300.0),
        ("chrY", "chrY", 3_000_000, "A", "C", 0, 0, 0, 1, 0, 1, 0, 1, 3, 30.0, 300.0),
        ("chrX", "chrX", 3_000_000, "A", "C", 1, 0, 0, 1, 0, 1, 0, 0, 3, 30.0, 300.0),
        ("chrX", "chrX", 1_000, "A", "C", 1, 0, 0, 1, 0, 0, 0, 0, 3, 30.0, 300.0),
        ("chr2", "chr2", 1_000, "A", "C", 0, 0, 0, 1, 0, 0, 2, 0, 3, 30.0, 300.0),
        ("chr2", "chr2", 1_001, "A", "C", 0, 0, 0, 0, 0, 0, 2, 0, 3, 30.0, 300.0),  # no AC: dropped
    ]
    c = spark.createDataFrame(rows, COUNTS_DDL)
    got = {(r.contig, r.pos): (r.XX_AN, r.XY_AN) for r in finalize(c, info(spark, 5, 4)).collect()}
    assert got == {
        ("chrM", 10): (4, 4),
        ("chrY", 3_000_000): (0, 3),
        ("chrX", 3_000_000): (10, 4),
        ("chrX", 1_000): (10, 8),
        ("chr2", 1_000): (6, 8),
    }


def test_merge_of_centers_equals_count_of_all(spark):
    g = genotypes_from_tables(spark, SF001)
    whole = count_dataset(g)
    parts = [count_dataset(g.where(F.col("file") == f)) for f in ["center0.vcf.gz", "center1.vcf.gz"]]
    merged = merge_counts([p.counts for p in parts])
    key = ["region", "pos", "ref", "alt"]
    assert merged.exceptAll(whole.counts.select(*merged.columns)).count() == 0
    assert whole.counts.select(*merged.columns).exceptAll(merged).count() == 0
    mi = merge_info([p.info for p in parts]).first()
    wi = whole.info.first()
    assert mi.sample_number == wi.sample_number
    a = finalize(merged, merge_info([p.info for p in parts]))
    b = finalize(whole.counts, whole.info)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_rejects_different_filters(spark):
    with pytest.raises(Exception, match="different filter"):
        merge_info([info(spark, 1, 1), info(spark, 1, 1, dp=5)]).collect()


def test_results_do_not_depend_on_partitioning(spark):
    g = genotypes_from_tables(spark, SF001)
    a = count_dataset(g).counts
    b = count_dataset(g.repartition(13, "pos")).counts
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_hot_variant_counts_exactly(spark):
    """One site carrying about a third of all calls: partial aggregation keeps it exact."""
    g = genotypes_from_tables(spark, SF001)
    site = g.where(
        (F.col("contig") == "chr1")
        & (F.col("gt") == F.array(F.lit(1), F.lit(1)))
        & F.col("dp").isNotNull()
        & ~F.get("alts", 0).isin("*", "<NON_REF>")
    ).orderBy("pos", "file", "sample_rank", "dp", "gq").limit(1)
    n_all = g.count()
    hot = site.select(F.explode(F.sequence(F.lit(1), F.lit(n_all // 2))).alias("_i"), *site.columns).drop("_i")
    ds = count_dataset(g.unionByName(hot).repartition(7))
    base = count_dataset(g)
    r = site.first()
    key = (F.col("pos") == r.pos) & (F.col("ref") == r.ref) & (F.col("alt") == r.alts[0])
    a = ds.counts.where(key).first()
    b = base.counts.where(key).first()
    assert a.n_samples == b.n_samples + n_all // 2
    assert a.DP_sum == b.DP_sum + (n_all // 2) * r.dp
    others = ds.counts.where(~key)
    assert others.exceptAll(base.counts.where(~key)).count() == 0
