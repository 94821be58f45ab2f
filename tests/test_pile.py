"""Literal-row tests for every call-classification branch and the filter rules."""

import pytest
from pyspark.sql import functions as F

from cohortac.plans.pipeline import Filters, pile_for
from helpers import geno

from cohortac.constants import PILE_COLUMNS


def samples(spark, rows):
    return spark.createDataFrame(rows, "file string, sample_rank int, sex string")


def pile(spark, rows, sexes=(("f.vcf.gz", 0, "XX"),), **kw):
    g = geno(spark, rows)
    p = pile_for(g, samples(spark, list(sexes)), filters=Filters(**kw))
    cols = ["alt", "XX_AC", "XX_AC_hom", "XX_AC_hemi", "XX_n_DP_discarded", "XY_AC", "XY_AC_hom", "XY_AC_hemi",
            "XY_n_DP_discarded", "DP"]
    return sorted(tuple(r) for r in p.select(*cols).collect())


XY = (("f.vcf.gz", 0, "XY"),)


def test_pile_columns(spark):
    g = geno(spark, [{}])
    p = pile_for(g, samples(spark, [("f.vcf.gz", 0, "XX")]))
    assert p.columns == PILE_COLUMNS


def test_het_pass_and_ab_fail(spark):
    assert pile(spark, [dict(gt=[0, 1], ad=[15, 15, 0])]) == [("C", 1, 0, 0, 0, 0, 0, 0, 0, 30)]
    # AB reads AD[a-1] (the reference depth for a=1): 5/30 fails
    assert pile(spark, [dict(gt=[0, 1], ad=[5, 25, 0])]) == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30)]
    # equality fails: 6/30 == 0.2
    assert pile(spark, [dict(gt=[1, 0], ad=[6, 24, 0])]) == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_ab_index_alt_option(spark):
    assert pile(spark, [dict(gt=[0, 1], ad=[5, 25, 0])], ab_index="alt") == [("C", 1, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_missing_ad_or_zero_dp_fails_het(spark):
    assert pile(spark, [dict(gt=[0, 1], ad=None)]) == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(gt=[0, 1], ad=[None, 3])]) == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_hom_alt_has_no_ab_test(spark):
    assert pile(spark, [dict(gt=[1, 1], ad=[0, 0, 0])]) == [("C", 2, 1, 0, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(gt=[2, 2], ad=None)]) == [("G", 2, 1, 0, 0, 0, 0, 0, 0, 30)]


def test_multi_allelic_independent_ab(spark):
    # AB(1) = AD[0]/30 = 0.33 passes, AB(2) = AD[1]/30 = 0.07 fails
    got = pile(spark, [dict(gt=[1, 2], ad=[10, 2, 18])])
    assert got == [("C", 1, 0, 0, 0, 0, 0, 0, 0, 30), ("G", 0, 0, 0, 0, 0, 0, 0, 0, 30)]
    # fail then pass: the second allele is not affected by the first
    got = pile(spark, [dict(gt=[1, 2], ad=[2, 10, 18])])
    assert got == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30), ("G", 1, 0, 0, 0, 0, 0, 0, 0, 30)]
    # both fail
    got = pile(spark, [dict(gt=[2, 1], ad=[1, 1, 28])])
    assert got == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30), ("G", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_multi_allelic_gq_fail_keeps_both_failed(spark):
    got = pile(spark, [dict(gt=[1, 2], ad=[10, 10, 10], gq=5)])
    assert got == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30), ("G", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_haploid(spark):
    assert pile(spark, [dict(gt=[1])]) == [("C", 1, 0, 1, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(gt=[0])]) == [("A", 0, 0, 0, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(gt=[None])]) == [("A", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_hom_ref_and_missing_give_ref_rows(spark):
    assert pile(spark, [dict(gt=[0, 0])]) == [("A", 0, 0, 0, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(gt=[None, None])]) == [("A", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_hemizygous_x_non_par(spark):
    x = dict(contig="chrX", pos=3_000_000)
    assert pile(spark, [dict(x, gt=[1, 1])], XY) == [("C", 0, 0, 0, 0, 1, 0, 1, 0, 30)]
    assert pile(spark, [dict(x, gt=[0, 1])], XY) == [("C", 0, 0, 0, 0, 1, 0, 1, 0, 30)]
    # multi-allelic: single-copy counts for each allele
    got = pile(spark, [dict(x, gt=[1, 2], ad=[10, 10, 10])], XY)
    assert got == [("C", 0, 0, 0, 0, 1, 0, 1, 0, 30), ("G", 0, 0, 0, 0, 1, 0, 1, 0, 30)]
    # XX on chrX non-PAR is diploid
    assert pile(spark, [dict(x, gt=[1, 1])]) == [("C", 2, 1, 0, 0, 0, 0, 0, 0, 30)]
    # PAR1 on chrX: diploid for XY
    assert pile(spark, [dict(contig="chrX", pos=1000, gt=[1, 1])], XY) == [("C", 0, 0, 0, 0, 2, 1, 0, 0, 30)]
    # 'X' naming is recognised by the count step
    assert pile(spark, [dict(contig="X", pos=3_000_000, gt=[1, 1])], XY, ) == []  # not a default region


def test_chry_rules(spark):
    y = dict(contig="chrY", gt=[1, 1])
    assert pile(spark, [dict(y, pos=3_000_000)]) == []  # XX skipped
    assert pile(spark, [dict(y, pos=100)], XY) == []  # PAR1
    assert pile(spark, [dict(y, pos=57_000_000)], XY) == []  # PAR2
    assert pile(spark, [dict(y, pos=3_000_000)], XY) == [("C", 0, 0, 0, 0, 1, 0, 1, 0, 30)]
    assert pile(spark, [dict(y, pos=57_300_000)], XY) == [("C", 0, 0, 0, 0, 1, 0, 1, 0, 30)]


def test_dp_rules(spark):
    assert pile(spark, [dict(dp=None)]) == []
    assert pile(spark, [dict(dp=5, ad=[3, 2, 0])]) == [("C", 0, 0, 0, 1, 0, 0, 0, 0, 5)]
    # GQ missing counts as 0: not passed, AN not reduced
    assert pile(spark, [dict(gq=None)]) == [("C", 0, 0, 0, 0, 0, 0, 0, 0, 30)]


def test_spanning_deletion_and_gvcf(spark):
    assert pile(spark, [dict(alts=["*", "G"], gt=[1, 2], ad=[10, 10, 10])]) == [("G", 1, 0, 0, 0, 0, 0, 0, 0, 30)]
    assert pile(spark, [dict(alts=["<NON_REF>"], gt=[0, 0])]) == []
    # a called <NON_REF> second allele is kept as text
    got = pile(spark, [dict(alts=["C", "<NON_REF>"], gt=[2, 2])])
    assert got == [("<NON_REF>", 2, 1, 0, 0, 0, 0, 0, 0, 30)]


def test_ploidy_three_gives_no_rows(spark):
    assert pile(spark, [dict(gt=[0, 1, 1])]) == []


def test_half_missing_is_error_or_dropped(spark):
    with pytest.raises(Exception, match="Half-missing"):
        pile(spark, [dict(gt=[0, None])])
    assert pile(spark, [dict(gt=[0, None])], on_unsupported="drop") == []
    assert pile(spark, [dict(gt=[None, 1])], on_unsupported="drop") == []


def test_record_without_alt(spark):
    with pytest.raises(Exception, match="without ALT"):
        pile(spark, [dict(alts=[], gt=[0, 0])])
    assert pile(spark, [dict(alts=[], gt=[0, 0])], on_unsupported="drop") == []


def test_ac_identity(spark):
    """AC = 2*hom + hemi + het over the pile."""
    rows = [dict(gt=[1, 1]), dict(gt=[0, 1]), dict(gt=[1]), dict(gt=[1, 2], ad=[10, 10, 10]),
            dict(contig="chrX", pos=3_000_000, gt=[1, 1], sample_rank=1)]
    g = geno(spark, rows)
    s = samples(spark, [("f.vcf.gz", 0, "XX"), ("f.vcf.gz", 1, "XY")])
    p = pile_for(g, s)
    r = p.agg(*[F.sum(c).alias(c) for c in ["XX_AC", "XX_AC_hom", "XX_AC_hemi", "XY_AC", "XY_AC_hom", "XY_AC_hemi"]]).first()
    assert r.XX_AC == 2 + 1 + 1 + 2  # hom 2, het 1, haploid 1, multi 1+1
    assert r.XX_AC_hom == 1 and r.XX_AC_hemi == 1
    assert (r.XY_AC, r.XY_AC_hom, r.XY_AC_hemi) == (1, 0, 1)


def test_normalize_contigs(spark):
    from cohortac.plans.pipeline import count_dataset

    rows = [dict(contig="X", pos=3_000_000, gt=[1, 1]), dict(contig="X", pos=3_000_100, gt=[1, 1])]
    g = geno(spark, rows)
    plain = count_dataset(g)
    assert plain.counts.count() == 0  # 'X' is not a default region and inference sees no chrX
    norm = count_dataset(g, filters=Filters(normalize_contigs=True))
    assert [tuple(r) for r in norm.samples.select("sex").collect()] == [("XY",)]
    got = sorted((r.region, r.XY_AC, r.XY_AC_hemi) for r in norm.counts.collect())
    assert got == [("chrX", 1, 1), ("chrX", 1, 1)]
    r = count_dataset(g, regions=["X:2999999-3000050"], filters=Filters(normalize_contigs=True))
    assert [x.region for x in r.counts.collect()] == ["X:2999999-3000050"]
