"""Incremental counting with Structured Streaming.

Centers keep delivering new call files. Every micro-batch is appended, as typed calls, to one
Parquet table: the ``batch=<id>`` partition of ``<out>/calls`` (and of ``<out>/samples`` for
sources that carry headers), written with dynamic partition overwrite, so a batch that is
retried after a failure rewrites only its own partition and the table is exactly-once together
with the stream's checkpoint. A sample's calls may come in any number of batches: its sex is
inferred from all of them, so the running counts are those of the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.plans.pipeline import CountDataset, Filters, count_dataset

CALL_COLUMNS = ("file", "sample_rank", "contig", "pos", "end", "ref", "alts", "gt", "dp", "gq", "ad")


def _append(df: DataFrame, path: str, batch_id: int) -> None:
    with_id = df.withColumn("batch", F.lit(int(batch_id)).cast("long"))
    with_id.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def ingest_batches(
    stream: DataFrame,
    to_genotypes: Callable[[DataFrame], DataFrame],
    out_dir: str,
    checkpoint_location: str,
    available_now: bool = True,
    processing_time: str | None = None,
):
    """Start the stream: each micro-batch -> typed calls in ``<out>/calls``.

    ``to_genotypes`` maps a micro-batch of the source to the genotype layout, or to a
    (genotypes, header samples) pair for sources that carry headers (VCF text). With
    ``available_now`` the query processes what is there and stops; otherwise it runs on a
    processing-time trigger. Returns the StreamingQuery.
    """
    root = out_dir.rstrip("/")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        calls = to_genotypes(batch)
        calls, header = calls if isinstance(calls, tuple) else (calls, None)
        _append(calls.select(*CALL_COLUMNS, *[c for c in ("sample",) if c in calls.columns]), f"{root}/calls", batch_id)
        if header is not None:
            _append(header, f"{root}/samples", batch_id)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")
    return w.start()


def running_counts(spark: SparkSession, out_dir: str, with_headers: bool, regions=None, filters: Filters = Filters()) -> CountDataset:
    """Count dataset of all batches written so far."""
    root = out_dir.rstrip("/")
    header = spark.read.parquet(f"{root}/samples").drop("batch").distinct() if with_headers else None
    return count_dataset(spark.read.parquet(f"{root}/calls").drop("batch"), regions, filters, header_samples=header)


def vcf_batch_genotypes(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``to_genotypes`` for a ``vcf_stream`` micro-batch: (genotypes, header samples)."""
    from cohortac.sources.vcf import header_float_keys, header_samples, parse_sites, sites_to_genotypes, with_float_keys

    return sites_to_genotypes(with_float_keys(parse_sites(batch), header_float_keys(batch))), header_samples(batch)


def vcf_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new ``.vcf``/``.vcf.gz`` files in a directory as a stream of (file, value).

    The file stream reads through Spark's text source, so BGZF (``.vcf.bgz``) files are not
    picked up here; batch jobs read them with the ``vcf_bgzf`` source."""
    r = spark.readStream.format("text").option("pathGlobFilter", "*.{vcf,vcf.gz}")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(directory).select(F.col("_metadata.file_path").alias("file"), "value")
