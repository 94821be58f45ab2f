"""Readers and writers of the engine's tables.

A count dataset is a folder of versions, of which readers see the current one::

    <dir>/_current                 name of the current version, replaced as the last step of a write
    <dir>/v-<id>/info.json/        one-row JSON: version, sample_number{XX,XY}, AC0_filter{...}
    <dir>/v-<id>/samples/          Parquet: file, sample_rank, sample, n_hom, n_het, sex
    <dir>/v-<id>/counts/region=<r>/  Parquet, ZSTD, rows range-partitioned and sorted by (pos, ref, alt)
    <dir>/v-<id>/manifest/         region, holder (the version whose counts hold it), n_rows, pos_min, pos_max

A write goes beside the current version and is published by one rename; a job that breaks before that
leaves the old version readable, and a folder without ``_current`` is not a dataset. A version may keep
regions in the counts of an earlier one (``holder``), so a merge that touches few regions writes only those. Versions
that no region refers to are removed once the new one is published. A result folder is built the
same way, with ``result/region=<r>/`` in place of samples and counts.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortac.constants import COUNTS_SCHEMA, INFO_SCHEMA, PILE_COLUMNS, RESULT_COLUMNS, SAMPLES_SCHEMA
from cohortac.session import broadcast_if_bounded, remove_path

PILE_TSV_DDL = (
    "pos INT, ref STRING, alt STRING, XX_AC INT, XX_AC_hom INT, XX_AC_hemi INT, XX_n_DP_discarded INT, "
    "XY_AC INT, XY_AC_hom INT, XY_AC_hemi INT, XY_n_DP_discarded INT, DP INT"
)

RESULT_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("region", "contig")]
    + [T.StructField("pos", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("ref", "alt")]
    + [T.StructField(c, T.IntegerType()) for c in RESULT_COLUMNS[5:13]]
    + [T.StructField(c, T.DoubleType()) for c in ("DP_mean", "DP_std")]
)


def _p(base: str, name: str) -> str:
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


def sorted_by_region(df: DataFrame, n_partitions: int | None = None) -> DataFrame:
    """Range-partition on (region, pos) and sort inside partitions: each task writes few region
    folders, files come out ordered by position (row-group pruning on pos). Without an explicit
    count, AQE sizes the partitions (no flood of tiny files for small outputs)."""
    r = df.repartitionByRange(n_partitions, "region", "pos") if n_partitions else df.repartitionByRange("region", "pos")
    return r.sortWithinPartitions("region", "pos", "ref", "alt")


def write_info(info: DataFrame, path: str) -> None:
    info.coalesce(1).write.mode("overwrite").json(path)


def read_info(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INFO_SCHEMA).json(path)


# ---------------------------------------------------------------- versions
CURRENT = "_current"
MANIFEST_SCHEMA = "region string, holder string, n_rows bigint, pos_min int, pos_max int"


def _fs(spark: SparkSession, path: str):
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hp, hp.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hp, fs = _fs(spark, path)
    return fs.exists(hp)


def current(spark: SparkSession, in_dir: str) -> str:
    """Folder of a dataset's current version; an error if nothing was published there."""
    hp, fs = _fs(spark, _p(in_dir, CURRENT))
    if not fs.exists(hp):
        raise FileNotFoundError(f"No complete dataset in {in_dir}")
    stream = fs.open(hp)
    try:
        return _p(in_dir, bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def part(spark: SparkSession, in_dir: str, name: str) -> str:
    """Folder of a part (``pile``, ``reports/inputs`` ...) of the current version."""
    return _p(current(spark, in_dir), name)


def _publish(spark: SparkSession, out_dir: str, version: str) -> None:
    """Make a version the current one: its name is written beside and renamed into place, which readers
    see wholly or not at all."""
    jvm = spark._jvm
    beside, fs = _fs(spark, _p(out_dir, f"{CURRENT}-{version}"))
    stream = fs.create(beside, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    modes = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(modes, 1)
    over[0] = modes.OVERWRITE
    target = fs.makeQualified(jvm.org.apache.hadoop.fs.Path(_p(out_dir, CURRENT)))
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(beside), target, over)


def write_version(spark: SparkSession, out_dir: str, write: Callable[[str], set[str] | None]) -> None:
    """Run ``write(folder)`` for a new version and publish it; of a failed write nothing stays. ``write``
    gives the names of earlier versions that the new one still refers to; all others are removed."""
    version = f"v-{uuid.uuid4().hex}"
    folder = _p(out_dir, version)
    try:
        kept = write(folder) or set()
        _publish(spark, out_dir, version)
    except BaseException:
        remove_path(spark, folder)
        raise
    hp, fs = _fs(spark, out_dir)
    for status in fs.listStatus(hp):
        name = status.getPath().getName()
        if re.fullmatch("v-[0-9a-f]{32}", name) and name != version and name not in kept:
            remove_path(spark, _p(out_dir, name))


# ---------------------------------------------------------------- count datasets
def _write_regions(df: DataFrame, path: str, n_partitions: int | None = None) -> None:
    sorted_by_region(df, n_partitions).write.mode("overwrite").option("compression", "zstd").partitionBy("region").parquet(path)


def write_counts(spark: SparkSession, folder: str, samples: DataFrame, info: DataFrame, counts: DataFrame, n_partitions: int | None = None,
                 others: DataFrame | None = None) -> None:
    """The parts of a version. ``others`` are manifest rows of regions that stay in earlier versions."""
    write_info(info, _p(folder, "info.json"))
    samples.write.mode("overwrite").parquet(_p(folder, "samples"))
    _write_regions(counts, _p(folder, "counts"), n_partitions)
    written = _counts_of(spark, [_p(folder, "counts")])
    rows = written.groupBy("region").agg(
        F.lit(folder.rstrip("/").rsplit("/", 1)[-1]).alias("holder"), F.count(F.lit(1)).alias("n_rows"), F.min("pos").alias("pos_min"), F.max("pos").alias("pos_max")
    )
    rows = rows if others is None else rows.unionByName(others)
    rows.coalesce(1).write.mode("overwrite").parquet(_p(folder, "manifest"))  # a row for each region


def write_count_dataset(samples: DataFrame, info: DataFrame, counts: DataFrame, out_dir: str, n_partitions: int | None = None) -> None:
    spark = counts.sparkSession
    write_version(spark, out_dir, lambda folder: write_counts(spark, folder, samples, info, counts, n_partitions))


def manifest(spark: SparkSession, *in_dirs: str) -> DataFrame:
    """(region, holder, n_rows, pos_min, pos_max) of count datasets."""
    return spark.read.schema(MANIFEST_SCHEMA).parquet(*[part(spark, d, "manifest") for d in in_dirs])


def _path_piece(pattern: str) -> Column:
    """A piece of a row's file path; a folder name is escaped once by the writer and once in the path."""
    return F.url_decode(F.url_decode(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)))


def _counts_of(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Counts of one folder by its partitions, of several in one scan with the region read off the path; then
    with ``_root`` and ``_holder`` (dataset folder and version)."""
    names = COUNTS_SCHEMA.fieldNames()
    if len(folders) == 1:
        return spark.read.schema(COUNTS_SCHEMA).parquet(folders[0]).select(*names)
    plain = T.StructType([f for f in COUNTS_SCHEMA.fields if f.name != "region"])
    scan = spark.read.schema(plain).option("recursiveFileLookup", True).parquet(*folders)
    scan = scan.withColumn("region", _path_piece("/region=([^/]*)/")).withColumn("_holder", _path_piece("/(v-[0-9a-f]+)/counts/"))
    return scan.select(*names, "_holder")


def read_counts(spark: SparkSession, *in_dirs: str) -> DataFrame:
    """Counts of a dataset, or of several (one scan, whatever their number)."""
    versions = {current(spark, d).rsplit("/", 1)[-1]: d for d in in_dirs}
    found = spark.read.schema(MANIFEST_SCHEMA).parquet(*[_p(d, f"{v}/manifest") for v, d in versions.items()])
    found = found.select("region", "holder", _path_piece("/(v-[0-9a-f]+)/manifest/").alias("version"))
    held = found.select("version", "holder").distinct().collect()  # a row for each version that is still in use
    folders = sorted(_p(versions[r.version], f"{r.holder}/counts") for r in held)
    if not folders:
        return spark.createDataFrame([], COUNTS_SCHEMA)
    counts = _counts_of(spark, folders)
    if len(folders) == 1:
        return counts
    same = (counts["region"] == found["region"]) & (counts["_holder"] == found["holder"])
    return counts.join(broadcast_if_bounded(found), same, "left_semi").drop("_holder")


def read_samples(spark: SparkSession, *in_dirs: str) -> DataFrame:
    return spark.read.schema(SAMPLES_SCHEMA).parquet(*[part(spark, d, "samples") for d in in_dirs])


def read_dataset_info(spark: SparkSession, *in_dirs: str) -> DataFrame:
    return spark.read.schema(INFO_SCHEMA).json([part(spark, d, "info.json") for d in in_dirs])


def list_regions(spark: SparkSession, in_dir: str) -> DataFrame:
    """Regions present in a count dataset (from its manifest; no data file is opened)."""
    return manifest(spark, in_dir).select("region")


# ---------------------------------------------------------------- results
def write_result(result: DataFrame, info: DataFrame, out_dir: str, n_partitions: int | None = None) -> None:
    def write(folder: str) -> None:
        write_info(info, _p(folder, "info.json"))
        _write_regions(result, _p(folder, "result"), n_partitions)

    write_version(result.sparkSession, out_dir, write)


def read_result(spark: SparkSession, in_dir: str) -> DataFrame:
    return spark.read.schema(RESULT_SCHEMA).parquet(part(spark, in_dir, "result")).select(*RESULT_SCHEMA.fieldNames())


# ---------------------------------------------------------------- piles
PILE_SALTS = 64


def write_pile(pile: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ()) -> None:
    """Keep the per-call pile: Parquet partitioned by ``by`` and region, or headerless TSV.

    Rows are range-partitioned by region and position (a position with very many rows also by a hash of the row), in
    partitions that Spark sizes by bytes, and sorted: a region has as many files as its bytes need, whatever
    the number of tasks before, and a position range skips row groups.
    """
    if fmt == "parquet":
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in pile.columns]), F.lit(PILE_SALTS))
        dealt = pile.repartitionByRange(*by, "region", "pos", salt).sortWithinPartitions(*by, "region", "pos")
        dealt.write.mode("overwrite").option("compression", "zstd").partitionBy(*by, "region").parquet(path)
    elif fmt == "tsv":
        pile.select(*[c.strip().split(" ")[0] for c in PILE_TSV_DDL.split(",")]).write.mode("overwrite").option(
            "sep", "\t"
        ).option("header", False).csv(path)
    else:
        raise ValueError(fmt)


PILE_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType() if c in ("region", "contig", "ref", "alt") else T.IntegerType())
        for c in PILE_COLUMNS
    ]
)


def read_pile(spark: SparkSession, path: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The kept pile (Parquet, partitioned by ``by`` and region), all of it in one scan."""
    schema = T.StructType([*PILE_SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in by]])
    return spark.read.schema(schema).parquet(path).select(*PILE_COLUMNS, *by)


def read_count_files(spark: SparkSession, pattern: str) -> DataFrame:
    """Counts of all Parquet files that match a path or glob pattern; folder names are not columns."""
    return spark.read.schema(COUNTS_SCHEMA).parquet(pattern)


def read_pile_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Typed, headerless, tab-separated pile scan with a fixed schema (no inference)."""
    return spark.read.schema(PILE_TSV_DDL).option("sep", "\t").option("header", False).option("mode", "FAILFAST").csv(path)


def _table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; of a dataset or result folder its counts or result, of ``<folder>/<part>`` that part
    of the current version."""
    folder, _, name = path.rstrip("/").rpartition("/")
    if exists(spark, _p(path, CURRENT)):
        return read_result(spark, path) if exists(spark, part(spark, path, "result")) else read_counts(spark, path)
    if folder and exists(spark, _p(folder, CURRENT)):
        return read_counts(spark, folder) if name == "counts" else spark.read.parquet(part(spark, folder, name))
    return spark.read.parquet(path)


def inspect(source, where: str | None = None) -> DataFrame:
    """All columns of a table (session and path, see ``_table``) or DataFrame, optionally filtered by a SQL
    expression."""
    df = source if isinstance(source, DataFrame) else _table(*source)
    return df.where(F.expr(where)) if where else df


def inspect_to_tsv(source, out_path: str, where: str | None = None) -> None:
    """``inspect`` written as tab-separated text with a header line."""
    inspect(source, where).write.mode("overwrite").option("sep", "\t").option("header", True).csv(out_path)
