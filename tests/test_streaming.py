"""Incremental counting: VCF files arriving one per micro-batch give the batch result."""

import gzip

from cohortac.operators.finalize import finalize
from cohortac.plans.pipeline import count_dataset
from cohortac.streaming.counts import ingest_batches, running_counts, vcf_batch_genotypes, vcf_stream
from test_jobs import result_rows, write_vcf_files


def test_vcf_stream_one_file_per_batch(spark, tmp_path):
    d = tmp_path / "incoming"
    d.mkdir()
    g, paths = write_vcf_files(spark, d)
    # the stream reads text; turn the .bgz one into a plain .vcf
    for p in paths:
        if p.endswith(".bgz"):
            import os
            raw = gzip.decompress(open(p, "rb").read())  # BGZF is valid multi-member gzip
            (d / os.path.basename(p).replace(".vcf.bgz", ".vcf")).write_bytes(raw)
            os.remove(p)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    q = ingest_batches(vcf_stream(spark, str(d), max_files_per_trigger=1), vcf_batch_genotypes, out, ckpt)
    q.awaitTermination()
    assert len(list((tmp_path / "out" / "calls").glob("batch=*"))) == 2
    found = running_counts(spark, out, with_headers=True)
    ds = count_dataset(g)
    assert result_rows(finalize(found.counts, found.info)) == result_rows(finalize(ds.counts, ds.info))


def test_restart_with_same_checkpoint_counts_files_once(spark, tmp_path):
    """A second run of the stream over the same checkpoint adds nothing; a new file adds one batch."""
    import shutil

    src = tmp_path / "src"
    src.mkdir()
    g, paths = write_vcf_files(spark, src)
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    gz = [p for p in paths if p.endswith(".vcf.gz")][0]
    shutil.copy(gz, incoming / "first.vcf.gz")
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")

    def run():
        q = ingest_batches(vcf_stream(spark, str(incoming)), vcf_batch_genotypes, out, ckpt)
        q.awaitTermination()

    run()
    first = running_counts(spark, out, with_headers=True).counts
    n1 = first.count()
    run()  # restart: nothing new
    assert len(list((tmp_path / "out" / "calls").glob("batch=*"))) == 1
    assert running_counts(spark, out, with_headers=True).counts.exceptAll(first).count() == 0
    # a second center arrives: plain text this time
    bgz = [p for p in paths if p.endswith(".vcf.bgz")][0]
    (incoming / "second.vcf").write_bytes(gzip.decompress(open(bgz, "rb").read()))
    run()
    assert len(list((tmp_path / "out" / "calls").glob("batch=*"))) == 2
    found = running_counts(spark, out, with_headers=True)
    assert found.counts.count() >= n1
    ds = count_dataset(g)
    assert result_rows(finalize(found.counts, found.info)) == result_rows(finalize(ds.counts, ds.info))


def test_samples_spread_over_batches_are_one_sample(spark, tmp_path):
    """The calls of every sample come in two files: 40 samples, sexes from all of their calls."""
    from cohortac.sources.projection import genotypes_from_tables
    from helpers import SF001

    lineitem = spark.read.parquet(f"{SF001}/lineitem.parquet")
    lineitem.where("l_orderkey % 2 = 0").write.parquet(str(tmp_path / "in" / "a"))
    lineitem.where("l_orderkey % 2 = 1").write.parquet(str(tmp_path / "in" / "b"))
    stream = spark.readStream.schema(lineitem.schema).option("maxFilesPerTrigger", "1").parquet(str(tmp_path / "in" / "*"))
    out = str(tmp_path / "out")
    ingest_batches(stream, lambda b: genotypes_from_tables(b.sparkSession, SF001, lineitem=b), out, str(tmp_path / "ckpt")).awaitTermination()
    assert len(list((tmp_path / "out" / "calls").glob("batch=*"))) >= 2
    found, ds = running_counts(spark, out, with_headers=False), count_dataset(genotypes_from_tables(spark, SF001))
    assert found.samples.count() == 40
    assert result_rows(finalize(found.counts, found.info)) == result_rows(finalize(ds.counts, ds.info))
