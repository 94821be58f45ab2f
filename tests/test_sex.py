"""Sex inference rules."""

import pytest

from cohortac.operators.sex import dataset_info, infer_sex
from helpers import geno

X = dict(contig="chrX", pos=3_000_000)


def sex_of(spark, rows, header=None, **kw):
    g = geno(spark, rows)
    h = spark.createDataFrame(header, "file string, sample_rank int, sample string") if header else None
    return {(r.file, r.sample_rank): (r.n_hom, r.n_het, r.sex) for r in infer_sex(g, h, **kw).collect()}


def test_fraction_limit(spark):
    # 1 het of 5 events = 0.2: not below the limit -> XX
    rows = [dict(X, gt=[0, 0])] * 2 + [dict(X, gt=[1, 1])] * 2 + [dict(X, gt=[0, 1])]
    assert sex_of(spark, rows)[("f.vcf.gz", 0)] == (4, 1, "XX")
    rows = rows + [dict(X, gt=[1, 1])]
    assert sex_of(spark, rows)[("f.vcf.gz", 0)] == (5, 1, "XY")


def test_no_events_is_xx(spark):
    rows = [dict(gt=[1, 1])]  # chr1 only
    got = sex_of(spark, rows, header=[("f.vcf.gz", 0, "S0"), ("f.vcf.gz", 1, "S1")])
    assert got == {("f.vcf.gz", 0): (0, 0, "XX"), ("f.vcf.gz", 1): (0, 0, "XX")}


def test_window_and_missing(spark):
    rows = [
        dict(X, gt=[None, None]),  # no event
        dict(contig="chrX", pos=1000, gt=[0, 1]),  # PAR1: outside the window
        dict(contig="chrX", pos=2_781_000, end=2_781_500, gt=[1, 1]),  # reaches into the window
        dict(X, alts=["<NON_REF>"], gt=[0, 0], dp=None),  # blocks and missing DP count
        dict(X, gt=[0, None]),  # half call is het
        dict(X, gt=[2]),  # haploid > 1 is het
    ]
    assert sex_of(spark, rows)[("f.vcf.gz", 0)] == (2, 2, "XX")


def test_haploid_01_is_error_or_hom(spark):
    with pytest.raises(Exception, match="unsupported ploidy"):
        sex_of(spark, [dict(X, gt=[1])])
    assert sex_of(spark, [dict(X, gt=[1])], on_unsupported="drop")[("f.vcf.gz", 0)] == (1, 0, "XY")


def test_only_chr_naming_used(spark):
    rows = [dict(contig="X", pos=3_000_000, gt=[1, 1])]
    assert sex_of(spark, rows)[("f.vcf.gz", 0)] == (0, 0, "XX")


def test_dataset_info(spark):
    rows = [dict(X, gt=[1, 1]), dict(X, gt=[0, 1], sample_rank=1, sample="S1")]
    s = infer_sex(geno(spark, rows))
    info = dataset_info(s, 10, 20, 0.2).first()
    assert (info.sample_number.XX, info.sample_number.XY) == (1, 1)
    assert (info.AC0_filter.min_DP, info.AC0_filter.min_GQ, info.AC0_filter.min_AB) == (10, 20, 0.2)
