"""Fixed values and schemas of the allele-count data model.

The numbers in the "fixed values" block below must stay exactly as they are:
results (hemizygous calls, allele numbers, sex calls, default filters) depend on them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results)
# ---------------------------------------------------------------------------
# GRCh38 pseudo-autosomal boundaries, 1-based coordinates.
PAR1_END = 2_781_479
PAR2_X_BEGIN = 155_701_383
PAR2_Y_BEGIN = 56_887_903
PAR2_Y_END = 57_217_415
# Sex inference: a het fraction on chrX non-PAR below this value means XY.
HET_FRACTION_LIMIT = 0.2
# Default call filters.
DEFAULT_MIN_DP = 10
DEFAULT_MIN_GQ = 20
DEFAULT_MIN_AB = 0.2
# Contig names with a sex-chromosome / mitochondrial meaning.
CHRX_NAMES = ("chrX", "X")
CHRY_NAMES = ("chrY", "Y")
# Finalize only knows the "chr" spelling of the special contigs.
FINALIZE_CHRX = "chrX"
FINALIZE_CHRY = "chrY"
FINALIZE_CHRM = "chrM"
# Default regions when none are given: chr1..chr22, chrX, chrY, chrM.
DEFAULT_CONTIGS = tuple([f"chr{i}" for i in range(1, 23)] + ["chrX", "chrY", "chrM"])
# Accepted input extensions of a directory listing.
SUPPORTED_EXTENSIONS = (".vcf.gz", ".vcf.bgz", ".bcf")
# Symbolic alleles.
GVCF_BLOCK_ALT = "<NON_REF>"
SPANNING_DELETION = "*"
# Allele counts (AC, AC_hom, AC_hemi) of a reference, homozygous, heterozygous and single-copy call.
ZERO_COUNTS = (0, 0, 0)
HOM_ALT_COUNTS = (2, 1, 0)
HET_COUNTS = (1, 0, 0)
HEMI_COUNTS = (1, 0, 1)
# Region text pattern: contig[:begin[-end]].
REGION_PATTERN = r"^(\w+)(:\d+|:\d+-\d+)?$"
# Dataset metadata version string written to info.json.
DATASET_VERSION = "0.1.0"
# ---------------------------------------------------------------------------

INT_MAX = 2_147_483_647

SAMPLES_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("sample_rank", T.IntegerType()),
        T.StructField("sample", T.StringType()),
        T.StructField("n_hom", T.LongType()),
        T.StructField("n_het", T.LongType()),
        T.StructField("sex", T.StringType()),
    ]
)

PILE_COLUMNS = [
    "region",
    "contig",
    "pos",
    "ref",
    "alt",
    "XX_AC",
    "XX_AC_hom",
    "XX_AC_hemi",
    "XX_n_DP_discarded",
    "XY_AC",
    "XY_AC_hom",
    "XY_AC_hemi",
    "XY_n_DP_discarded",
    "DP",
]

COUNT_SUMS = [
    "XX_AC",
    "XX_AC_hom",
    "XX_AC_hemi",
    "XY_AC",
    "XY_AC_hom",
    "XY_AC_hemi",
    "XX_n_DP_discarded",
    "XY_n_DP_discarded",
]

COUNTS_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("region", "contig")]
    + [T.StructField("pos", T.IntegerType())]
    + [T.StructField(c, T.StringType()) for c in ("ref", "alt")]
    + [T.StructField(c, T.IntegerType()) for c in COUNT_SUMS + ["n_samples"]]
    + [T.StructField(c, T.DoubleType()) for c in ("DP_sum", "DP2_sum")]
)

RESULT_COLUMNS = [
    "region",
    "contig",
    "pos",
    "ref",
    "alt",
    "XX_AN",
    "XX_AC",
    "XX_AC_hom",
    "XX_AC_hemi",
    "XY_AN",
    "XY_AC",
    "XY_AC_hom",
    "XY_AC_hemi",
    "DP_mean",
    "DP_std",
]

INFO_SCHEMA = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField(
            "sample_number",
            T.StructType([T.StructField("XX", T.IntegerType()), T.StructField("XY", T.IntegerType())]),
        ),
        T.StructField(
            "AC0_filter",
            T.StructType(
                [
                    T.StructField("min_DP", T.IntegerType()),
                    T.StructField("min_GQ", T.IntegerType()),
                    T.StructField("min_AB", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "settings",
            T.StructType(
                [
                    T.StructField("ab_index", T.StringType()),
                    T.StructField("on_unsupported", T.StringType()),
                    T.StructField("normalize_contigs", T.BooleanType()),
                ]
            ),
        ),
        # Sample numbers by the regions they were counted in; more than one entry after a merge of
        # datasets with different regions.
        T.StructField(
            "cohorts",
            T.ArrayType(
                T.StructType(
                    [T.StructField("regions", T.ArrayType(T.StringType())), T.StructField("XX", T.IntegerType()), T.StructField("XY", T.IntegerType())]
                )
            ),
        ),
    ]
)

GENOTYPE_COLUMNS = [
    "file",
    "sample_rank",
    "sample",
    "contig",
    "pos",
    "end",
    "ref",
    "alts",
    "gt",
    "dp",
    "gq",
    "ad",
]
