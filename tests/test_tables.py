"""Round trips of the dataset tables: info JSON, samples, counts, result."""

from cohortac.constants import COUNTS_SCHEMA, SAMPLES_SCHEMA
from cohortac.operators.finalize import finalize
from cohortac.plans.pipeline import Filters, count_dataset
from cohortac.sources import tables
from cohortac.sources.projection import genotypes_from_tables
from helpers import SF001


def test_dataset_round_trip(spark, tmp_path):
    g = genotypes_from_tables(spark, SF001)
    ds = count_dataset(g, regions=["chr1", "chrX:2781480-155701382"], filters=Filters(min_dp=12, min_gq=15, min_ab=0.25))
    out = str(tmp_path / "ds")
    tables.write_count_dataset(ds.samples, ds.info, ds.counts, out)
    info = tables.read_dataset_info(spark, out).collect()
    assert len(info) == 1
    assert (info[0].AC0_filter.min_DP, info[0].AC0_filter.min_GQ, info[0].AC0_filter.min_AB) == (12, 15, 0.25)
    assert info[0].sample_number.XX + info[0].sample_number.XY == 40
    assert tables.read_samples(spark, out).schema == SAMPLES_SCHEMA
    counts = tables.read_counts(spark, out)
    assert counts.schema == COUNTS_SCHEMA
    assert counts.exceptAll(ds.counts.select(*counts.columns)).count() == 0
    assert ds.counts.select(*counts.columns).exceptAll(counts).count() == 0
    res_dir = str(tmp_path / "res")
    tables.write_result(finalize(counts, tables.read_dataset_info(spark, out)), tables.read_dataset_info(spark, out), res_dir)
    res = tables.read_result(spark, res_dir)
    assert res.columns[:5] == ["region", "contig", "pos", "ref", "alt"]
    assert res.count() == finalize(ds.counts, ds.info).count()
    assert sorted(r.region for r in tables.list_regions(spark, out).collect()) == [
        "chr1",
        "chrX:2781480-155701382",
    ]
