"""Session helpers: building a session, the shared checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Broadcast limits used when a side is not known to be small. Row bounds are checked
# with a count before the hint is given; above them the join stays a shuffle join.
DEFAULT_BROADCAST_ROWS = 5_000_000
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024

# Runtime SQL settings the plans rely on. The genotype classification fuses into large
# whole-stage-codegen methods; HotSpot does not JIT-compile methods above 8000 bytes of
# bytecode, so such a stage would run interpreted. With this limit Spark falls back to
# per-operator code for those subtrees instead. (On a cluster, the JVM flag
# -XX:-DontCompileHugeMethods in spark.{driver,executor}.extraJavaOptions is an alternative.)
SQL_SETTINGS = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
JIT_FLAG = "-XX:-DontCompileHugeMethods"


def _jvm_compiles_huge_methods(spark: SparkSession) -> bool:
    conf = spark.sparkContext.getConf()
    opts = conf.get("spark.driver.extraJavaOptions", "") + " " + conf.get("spark.executor.extraJavaOptions", "")
    return JIT_FLAG in opts


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session (idempotent). When the JVMs were
    started with the JIT flag, large fused stages are compiled anyway and keep whole-stage
    codegen, so the method-size limit is left alone."""
    if _jvm_compiles_huge_methods(spark):
        return spark
    for k, v in SQL_SETTINGS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "cohortac") -> SparkSession:
    """Session with AQE on and the UI off; for local runs and tests."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
        .config("spark.sql.parquet.compression.codec", "zstd")
    )
    for k, v in SQL_SETTINGS.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    A folder of our own is only made when the setting is missing and Spark runs in
    local mode (tests); on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="cohortac-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Written as a Parquet table under ``<spark.checkpoint.dir>/tables/`` and read back: one
    job, columnar, and the result survives the loss of any executor. Reading it back also
    gives the planner exact file sizes for its broadcast decisions.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"t-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table inside the shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a table of ours (a file-system call on the driver; nothing happens if it is missing)."""
    hp = spark._jvm.org.apache.hadoop.fs.Path(path)
    hp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hp, True)


def _type_bytes(t: T.DataType) -> int:
    """Estimated in-memory bytes of a value (the same defaults Spark's planner uses)."""
    if isinstance(t, (T.StringType, T.BinaryType)):
        return 20
    if isinstance(t, T.ArrayType):
        return 4 + _type_bytes(t.elementType)
    if isinstance(t, T.MapType):
        return 4 + _type_bytes(t.keyType) + _type_bytes(t.valueType)
    if isinstance(t, T.StructType):
        return sum(_type_bytes(f.dataType) for f in t.fields)
    if isinstance(t, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    return 8


def _row_bytes(df: DataFrame) -> int:
    """Estimated bytes per row plus row overhead."""
    return _type_bytes(df.schema) + 16


def broadcast_if_bounded(df: DataFrame, max_rows: int | None = None, known_rows: int | None = None,
                         max_bytes: int | None = None) -> DataFrame:
    """Give the broadcast hint only when the side is proven small: its row count (``known_rows``
    when it is known by construction, e.g. a literal list; otherwise counted) is within
    ``max_rows`` and rows x estimated row width is within ``max_bytes``. Above either bound
    the DataFrame is returned unchanged and the planner keeps a shuffle join.

    Defaults come from the session (``spark.cohortac.broadcast.maxRows`` / ``.maxBytes``).
    """
    conf = df.sparkSession.conf
    max_rows = max_rows or int(conf.get("spark.cohortac.broadcast.maxRows", str(DEFAULT_BROADCAST_ROWS)))
    max_bytes = max_bytes or int(conf.get("spark.cohortac.broadcast.maxBytes", str(DEFAULT_BROADCAST_BYTES)))
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows and n * _row_bytes(df) <= max_bytes else df


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread an under-split source over the cluster.

    A source with fewer input partitions than the cluster's default parallelism (one
    unsplittable gzip file, a Parquet file with a single row group) would run every later
    map-side step in that few tasks. Only then is it repartitioned round-robin; a large,
    well-split input is returned untouched, so no extra shuffle is added at scale. The
    partition count comes from planning the scan (no job is run).
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df.repartition(target) if n < target else df
