"""Genotype calls derived from the driver's test tables (lineitem joined to orders).

No test table holds variant data, so the calls are projected with integer arithmetic
that DuckDB can repeat exactly (see FIXTURES.md §2):

* one call per lineitem row; the sample is ``o_custkey % 40``; samples 0-19 sit in
  file ``center0.vcf.gz`` and 20-39 in ``center1.vcf.gz`` (rank = sample % 20);
* the site (contig, pos, end, ref, alts) depends on ``l_partkey`` only;
* GT, DP, GQ and AD depend on the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.constants import PAR1_END, PAR2_X_BEGIN
from cohortac.session import ensure_parallelism

CONTIGS = ["chr1", "chr20", "chrX", "chrY", "chrM"]
BASES = ["A", "C", "G", "T"]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def projected_calls(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    """One row per lineitem with the raw fields the projection needs (no genotype logic).

    ``lineitem`` replaces the table read (e.g. a micro-batch of a lineitem stream)."""
    li = lineitem if lineitem is not None else spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    li = li.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    li = ensure_parallelism(li)
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey")
    return li.join(orders, li.l_orderkey == orders.o_orderkey, "inner").drop("o_orderkey")


def projected_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site per part: (p_partkey, contig, pos, end, ref, alts).

    Site attributes depend on the part key only, so they are computed once per part and
    joined to the calls; downstream filters on contig/pos then read plain columns (and are
    pushed to this small side) instead of re-evaluating the projection per call.
    """
    pk = F.col("p_partkey")
    slot = ((pk * 9973) % 2000).cast("int")
    contig = _pick(CONTIGS, pk % 5)
    pos = (
        F.when(contig == "chrX", slot * 80000 + 1)
        .when(contig == "chrY", slot * 30000 + 1)
        .otherwise(slot * 7 + 1)
        .cast("int")
    )
    alt0 = F.when(pk % 13 == 0, F.lit("<NON_REF>")).when(pk % 11 == 0, F.lit("*")).otherwise(_pick(BASES, (pk + 1) % 4))
    alt1 = _pick(BASES, (pk + 2) % 4)
    return (
        spark.read.parquet(f"{sf_dir}/part.parquet")
        .select("p_partkey")
        .select(
            "p_partkey",
            contig.alias("contig"),
            pos.alias("pos"),
            F.when(pk % 13 == 0, pos + 49).otherwise(pos + (pk % 3)).cast("int").alias("end"),
            _pick(BASES, pk % 4).alias("ref"),
            F.array(alt0, alt1).alias("alts"),
        )
    )


def genotypes_from_tables(spark: SparkSession, sf_dir: str, keep_keys: bool = False, lineitem: DataFrame | None = None) -> DataFrame:
    """Genotype calls in the engine's ``genotypes`` layout (see constants.GENOTYPE_COLUMNS).

    lineitem joins orders (sample) and the per-part sites; the planner broadcasts ``part``
    only when its file size is under the broadcast threshold, else it shuffles.
    """
    c = projected_calls(spark, sf_dir, lineitem)
    sites = projected_sites(spark, sf_dir)
    c = c.join(sites, c.l_partkey == sites.p_partkey, "inner").drop("p_partkey")
    ln = F.col("l_linenumber")
    sample_id = (F.col("o_custkey") % 40).cast("int")
    contig, pos = F.col("contig"), F.col("pos")
    nonparx = (contig == "chrX") & (pos > PAR1_END) & (pos < PAR2_X_BEGIN)
    odd = F.col("sample_id") % 2 == 1

    def g(*alleles):
        return F.array(*[F.lit(a).cast("int") for a in alleles])

    standard = (
        F.when(ln == 1, g(0, 0))
        .when(ln == 2, g(0, 1))
        .when(ln == 3, g(1, 0))
        .when(ln == 4, g(1, 1))
        .when(ln == 5, g(1, 2))
        .when(ln == 6, g(None, None))
    )
    gt = (
        F.when(
            nonparx & odd,
            F.when(ln.isin(1, 6), g(0, 0)).when((ln == 7) & (F.col("l_quantity") > 25), g(0, 1)).otherwise(g(1, 1)),
        )
        .when(contig == "chrX", F.coalesce(standard, g(0, 1)))
        .otherwise(F.coalesce(standard, g(1)))
    )
    phased = (ln == 3) & ~(nonparx & odd)
    dp = F.when(F.col("l_tax") != F.lit(0.08), F.col("l_quantity").cast("int"))
    gq = F.when(F.col("l_tax") != F.lit(0.07), (F.floor("l_extendedprice") % 100).cast("int"))
    k = F.round(F.col("l_discount") * 100).cast("int")
    ad = F.array(F.col("dp") - F.expr("div(dp * k, 10)").cast("int"), F.expr("div(dp * k, 10)").cast("int"), F.col("dp") % 5)

    return (
        c.withColumn("sample_id", sample_id)
        .withColumn("dp", dp)
        .withColumn("k", k)
        .select(
            F.concat(F.lit("center"), (F.col("sample_id") / 20).cast("int").cast("string"), F.lit(".vcf.gz")).alias(
                "file"
            ),
            (F.col("sample_id") % 20).cast("int").alias("sample_rank"),
            F.concat(F.lit("S"), F.lpad(F.col("sample_id").cast("string"), 2, "0")).alias("sample"),
            "contig",
            "pos",
            "end",
            "ref",
            "alts",
            gt.alias("gt"),
            phased.alias("phased"),
            "dp",
            gq.alias("gq"),
            ad.alias("ad"),
            *(["l_orderkey", "l_partkey", "l_linenumber"] if keep_keys else []),
        )
    )


# DuckDB text of the same projection, shared by the oracle queries.
ORACLE_GENOTYPES_CTE = """
calls AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount, l.l_tax,
           CAST(o.o_custkey % 40 AS INTEGER) AS sample_id,
           CAST((l.l_partkey * 9973) % 2000 AS INTEGER) AS slot,
           (['chr1','chr20','chrX','chrY','chrM'])[CAST(l.l_partkey % 5 AS INTEGER) + 1] AS contig
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
calls2 AS (
    SELECT *,
        CAST(CASE WHEN contig = 'chrX' THEN slot * 80000 + 1
                  WHEN contig = 'chrY' THEN slot * 30000 + 1
                  ELSE slot * 7 + 1 END AS INTEGER) AS pos,
        CASE WHEN l_tax <> 0.08::DOUBLE THEN CAST(l_quantity AS INTEGER) END AS dp,
        CASE WHEN l_tax <> 0.07::DOUBLE THEN CAST(floor(l_extendedprice) % 100 AS INTEGER) END AS gq,
        CAST(round(l_discount * 100) AS INTEGER) AS k
    FROM calls
),
genotypes AS (
    SELECT
        'center' || CAST(sample_id // 20 AS VARCHAR) || '.vcf.gz' AS file,
        CAST(sample_id % 20 AS INTEGER) AS sample_rank,
        'S' || lpad(CAST(sample_id AS VARCHAR), 2, '0') AS sample,
        contig, pos,
        CAST(CASE WHEN l_partkey % 13 = 0 THEN pos + 49 ELSE pos + l_partkey % 3 END AS INTEGER) AS "end",
        (['A','C','G','T'])[CAST(l_partkey % 4 AS INTEGER) + 1] AS ref,
        CASE WHEN l_partkey % 13 = 0 THEN '<NON_REF>'
             WHEN l_partkey % 11 = 0 THEN '*'
             ELSE (['A','C','G','T'])[CAST((l_partkey + 1) % 4 AS INTEGER) + 1] END AS alt0,
        (['A','C','G','T'])[CAST((l_partkey + 2) % 4 AS INTEGER) + 1] AS alt1,
        CASE
          WHEN contig = 'chrX' AND pos > 2781479 AND pos < 155701383 AND sample_id % 2 = 1 THEN
            CASE WHEN l_linenumber IN (1, 6) THEN '0/0'
                 WHEN l_linenumber = 7 AND l_quantity > 25 THEN '0/1'
                 ELSE '1/1' END
          ELSE
            CASE l_linenumber WHEN 1 THEN '0/0' WHEN 2 THEN '0/1' WHEN 3 THEN '1|0' WHEN 4 THEN '1/1'
                              WHEN 5 THEN '1/2' WHEN 6 THEN './.'
                              ELSE CASE WHEN contig = 'chrX' THEN '0/1' ELSE '1' END END
        END AS gt_text,
        dp, gq,
        dp - (dp * k) // 10 AS ad0,
        (dp * k) // 10 AS ad1,
        dp % 5 AS ad2,
        l_orderkey, l_partkey, l_linenumber
    FROM calls2
),
gt AS (
    SELECT *,
        CASE WHEN gt_text = '1' THEN 1 ELSE 2 END AS ploidy,
        CASE WHEN gt_text IN ('./.') THEN NULL ELSE CAST(substr(gt_text, 1, 1) AS INTEGER) END AS g0,
        CASE WHEN gt_text IN ('./.', '1') THEN NULL ELSE CAST(substr(gt_text, 3, 1) AS INTEGER) END AS g1
    FROM genotypes
)
"""
