"""Oracle SQL text per registered query (DuckDB dialect, tables pre-registered as views)."""

from __future__ import annotations

from cohortac.constants import DEFAULT_CONTIGS
from cohortac.oracle import NONPAR_X, NONPAR_Y, SAMPLES_CTE, alleles_cte, calls_cte, full_chain, pile_cte, with_ctes

ORACLES: dict[str, str] = {}
KEYS = "l_orderkey, l_linenumber"
DEFAULT_CONTIGS_VALUES = "(VALUES " + ", ".join(f"('{c}')" for c in DEFAULT_CONTIGS) + ") AS dc(contig)"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = sql


def upto_calls(select: str) -> str:
    return with_ctes(SAMPLES_CTE, calls_cte(), select=select)


def upto_alleles(select: str) -> str:
    return with_ctes(SAMPLES_CTE, calls_cte(), alleles_cte(), select=select)


def upto_pile(select: str) -> str:
    return with_ctes(SAMPLES_CTE, calls_cte(), alleles_cte(), pile_cte(), select=select)


RESULT_SELECT = (
    "SELECT region, contig, pos, ref, alt, XX_AN, XX_AC, XX_AC_hom, XX_AC_hemi, XY_AN, XY_AC, XY_AC_hom, XY_AC_hemi, "
    "round(DP_mean, 6) AS DP_mean, round(DP_std, 6) AS DP_std FROM result"
)
PILE_COLS = (
    "region, contig, pos, ref, alt, XX_AC, XX_AC_hom, XX_AC_hemi, XX_n_DP_discarded, "
    "XY_AC, XY_AC_hom, XY_AC_hemi, XY_n_DP_discarded, DP"
)
STD_EXPR = (
    "sqrt(greatest((DP2_sum - 2 * (DP_sum / n_samples) * DP_sum + n_samples * ((DP_sum / n_samples) * (DP_sum / n_samples)))"
    " / n_samples, 0.0))"
)

# ------------------------------------------------------------------ flagship chain
oracle("finalize", full_chain(RESULT_SELECT))
oracle("allele_counts", full_chain("SELECT * FROM counts"))
oracle("infer_sex", with_ctes(SAMPLES_CTE, select="SELECT file, sample_rank, sample, n_hom, n_het, sex FROM samples"))
oracle(
    "dataset_info",
    with_ctes(
        SAMPLES_CTE,
        select="SELECT '0.1.0' AS version, n_xx AS XX, n_xy AS XY, CAST(10 AS INTEGER) AS min_DP, "
        "CAST(20 AS INTEGER) AS min_GQ, CAST(0.2 AS DOUBLE) AS min_AB FROM info",
    ),
)

# ------------------------------------------------------------------ filters
oracle(
    "drop_gvcf_blocks",
    with_ctes(select=f"SELECT file, sample_rank, contig, pos, ref, alt0, alt1, {KEYS} FROM gt WHERE alt0 <> '<NON_REF>'"),
)
_ALLELE_OUT = f"file, sample_rank, contig, pos, ref, alt, ac, ac_hom, ac_hemi, passed, {KEYS}"
oracle("explode_alleles", upto_alleles(f"SELECT {_ALLELE_OUT} FROM alleles"))
oracle("drop_spanning_deletion", upto_alleles(f"SELECT {_ALLELE_OUT} FROM alleles WHERE alt IS DISTINCT FROM '*'"))
oracle("missing_dp_filter", with_ctes(select=f"SELECT file, sample_rank, contig, pos, dp, {KEYS} FROM gt WHERE dp IS NOT NULL"))
oracle(
    "gq_pass",
    with_ctes(select=f"SELECT file, sample_rank, contig, pos, gq, coalesce(gq, 0) >= 20 AS gq_pass, {KEYS} FROM gt"),
)
_HET_ROWS = f"""
het AS (
    SELECT file, sample_rank, contig, pos, dp, ad0, ad1, g1 AS allele, {KEYS} FROM flags WHERE ploidy = 2 AND g0 = 0 AND g1 <> 0
    UNION ALL
    SELECT file, sample_rank, contig, pos, dp, ad0, ad1, g0, {KEYS} FROM flags WHERE ploidy = 2 AND g1 = 0 AND g0 <> 0
    UNION ALL
    SELECT file, sample_rank, contig, pos, dp, ad0, ad1, g0, {KEYS} FROM flags WHERE ploidy = 2 AND g0 <> g1 AND g0 <> 0 AND g1 <> 0
    UNION ALL
    SELECT file, sample_rank, contig, pos, dp, ad0, ad1, g1, {KEYS} FROM flags WHERE ploidy = 2 AND g0 <> g1 AND g0 <> 0 AND g1 <> 0
),
het_ab AS (
    SELECT *, coalesce(CAST(CASE allele WHEN 1 THEN ad0 WHEN 2 THEN ad1 END AS DOUBLE) / nullif(dp, 0), 0.0) AS ab FROM het
)
"""
oracle(
    "ab_pass",
    with_ctes(
        SAMPLES_CTE,
        calls_cte(),
        _HET_ROWS,
        select=f"SELECT file, sample_rank, contig, pos, allele, round(ab, 6) AS ab, ab > CAST(0.2 AS DOUBLE) AS ab_pass, {KEYS} FROM het_ab",
    ),
)
oracle(
    "dp_outcome",
    upto_alleles(
        "SELECT file, sample_rank, contig, pos, alt, "
        "CASE WHEN dp >= 10 AND passed THEN ac ELSE 0 END AS AC, "
        "CASE WHEN dp >= 10 AND passed THEN ac_hom ELSE 0 END AS AC_hom, "
        "CASE WHEN dp >= 10 AND passed THEN ac_hemi ELSE 0 END AS AC_hemi, "
        f"CASE WHEN dp >= 10 THEN 0 ELSE 1 END AS n_DP_discarded, {KEYS} FROM alleles WHERE alt IS DISTINCT FROM '*'"
    ),
)
oracle(
    "chry_filter",
    with_ctes(
        SAMPLES_CTE,
        select="SELECT g.file, g.sample_rank, g.contig, g.pos, s.sex, g.l_orderkey, g.l_linenumber FROM gt g "
        "JOIN samples s ON g.file = s.file AND g.sample_rank = s.sample_rank "
        f"WHERE g.contig NOT IN ('chrY', 'Y') OR (s.sex = 'XY' AND {NONPAR_Y.replace('pos', 'g.pos')})",
    ),
)
oracle(
    "par_classify",
    with_ctes(
        select=f"""SELECT DISTINCT contig, pos,
        CASE WHEN contig IN ('chrX', 'X') AND {NONPAR_X} THEN 'nonpar_x'
             WHEN contig IN ('chrX', 'X') THEN 'par_x'
             WHEN contig IN ('chrY', 'Y') AND {NONPAR_Y} THEN 'nonpar_y'
             WHEN contig IN ('chrY', 'Y') THEN 'par_y'
             ELSE 'autosomal' END AS par_class
        FROM gt"""
    ),
)
oracle("nonzero_variants", full_chain("SELECT * FROM counts WHERE XX_AC > 0 OR XY_AC > 0"))
oracle("inspect_filter", full_chain("SELECT * FROM counts WHERE XX_AC > 5 AND DP_sum > 100"))

# ------------------------------------------------------------------ genotype transforms
oracle(
    "gt_classify",
    with_ctes(
        select=f"""SELECT file, sample_rank, contig, pos,
        CASE gt_text WHEN '0/0' THEN 'hom_ref' WHEN './.' THEN 'missing' WHEN '0/1' THEN 'het' WHEN '1|0' THEN 'het'
                     WHEN '1/1' THEN 'hom_alt' WHEN '1/2' THEN 'multi_het' WHEN '1' THEN 'haploid_alt' END AS gt_class,
        {KEYS} FROM gt"""
    ),
)
_TRIPLE = f"file, sample_rank, contig, pos, alt, ac, ac_hom, ac_hemi, {KEYS}"
oracle("allele_count_triple", upto_alleles(f"SELECT {_TRIPLE} FROM alleles WHERE NOT hemi"))
oracle("hemizygous_counts", upto_alleles(f"SELECT {_TRIPLE} FROM alleles WHERE hemi"))
oracle(
    "allelic_balance",
    upto_calls(
        "SELECT file, sample_rank, contig, pos, "
        "round(coalesce(CAST(ad0 AS DOUBLE) / nullif(dp, 0), 0.0), 6) AS ab1, "
        f"round(coalesce(CAST(ad1 AS DOUBLE) / nullif(dp, 0), 0.0), 6) AS ab2, {KEYS} FROM flags"
    ),
)
oracle(
    "join_sample_sex",
    with_ctes(
        SAMPLES_CTE,
        select="SELECT g.file, g.sample_rank, g.sample, g.contig, g.pos, s.sex, g.l_orderkey, g.l_linenumber FROM gt g "
        "JOIN samples s ON g.file = s.file AND g.sample_rank = s.sample_rank",
    ),
)
oracle("sex_split_pile", upto_pile(f"SELECT {PILE_COLS}, file, sample_rank, sex, {KEYS} FROM pile"))
oracle("build_pile", upto_pile(f"SELECT {PILE_COLS} FROM pile"))

# ------------------------------------------------------------------ aggregates
oracle("union_piles", upto_pile(f"SELECT {PILE_COLS}, file FROM pile"))
oracle("depth_moments", full_chain("SELECT region, contig, pos, ref, alt, n_samples, DP_sum, DP2_sum FROM counts"))
oracle(
    "depth_list",
    upto_pile("SELECT region, contig, pos, ref, alt, DP, CAST(count(*) AS INTEGER) AS n_calls FROM pile GROUP BY ALL"),
)
oracle("allele_number", full_chain("SELECT region, contig, pos, ref, alt, XX_AN, XY_AN FROM result"))
oracle(
    "depth_mean_std",
    full_chain(
        f"SELECT region, contig, pos, ref, alt, round(DP_sum / n_samples, 6) AS DP_mean, round({STD_EXPR}, 6) AS DP_std FROM counts"
    ),
)
oracle("sorted_counts", full_chain("SELECT * FROM counts ORDER BY region, pos, ref, alt"))
oracle("merge_centers", full_chain(RESULT_SELECT))

# ------------------------------------------------------------------ regions
_REGION_TEXTS = """
pt AS (
    SELECT p_partkey, p_size, p_brand,
           (['chr1','chr20','chrX','chrY','chrM'])[CAST(p_partkey % 5 AS INTEGER) + 1] AS contig,
           CAST((p_partkey * 9973) % 2000 * 7 + 1 AS BIGINT) AS pos
    FROM part
),
texts AS (
    SELECT CASE p_partkey % 6
        WHEN 0 THEN contig
        WHEN 1 THEN contig || ':' || CAST(pos AS VARCHAR)
        WHEN 2 THEN contig || ':' || CAST(pos AS VARCHAR) || '-' || CAST(pos + p_size AS VARCHAR)
        WHEN 3 THEN contig || ':' || lpad(CAST(pos AS VARCHAR), 9, '0') || '-' || CAST(pos + p_size AS VARCHAR)
        WHEN 4 THEN contig || ':' || CAST(pos + p_size AS VARCHAR) || '-' || CAST(pos AS VARCHAR)
        ELSE CASE WHEN p_partkey % 12 = 5 THEN contig || ':99999999999999999999' ELSE p_brand END END AS text
    FROM pt
),
parsed0 AS (
    SELECT text, regexp_full_match(text, '(\\w+)(:\\d+|:\\d+-\\d+)?') AS ok,
           split_part(text, ':', 2) AS coords
    FROM texts
),
parsed AS (
    SELECT text, ok,
        CASE WHEN ok THEN split_part(text, ':', 1) END AS contig,
        CASE WHEN ok AND coords <> '' THEN TRY_CAST(split_part(coords, '-', 1) AS BIGINT) END AS "begin",
        CASE WHEN ok AND coords LIKE '%-%' THEN TRY_CAST(split_part(coords, '-', 2) AS BIGINT) END AS "end"
    FROM parsed0
),
regions AS (
    SELECT *, ok AND coalesce("begin" <= "end", true) AND text NOT LIKE '%:99999999999999999999' AS is_valid FROM parsed
)
"""
oracle("parse_regions", with_ctes(_REGION_TEXTS, select='SELECT text, contig, "begin", "end", is_valid FROM regions'))
oracle(
    "validate_regions",
    with_ctes(
        _REGION_TEXTS,
        select="SELECT text, is_valid, CASE WHEN NOT ok THEN 'format' WHEN text LIKE '%:99999999999999999999' THEN 'coordinate' WHEN NOT is_valid THEN 'begin_after_end' END AS reason FROM regions",
    ),
)
oracle("split_region_list", with_ctes(_REGION_TEXTS, select="SELECT text, count(*) AS n FROM texts GROUP BY text"))
oracle(
    "format_regions",
    with_ctes(
        _REGION_TEXTS,
        select="SELECT text, contig || coalesce(':' || CAST(\"begin\" AS VARCHAR), '') || coalesce('-' || CAST(\"end\" AS VARCHAR), '') AS region, "
        '"begin" - 1 AS begin0 FROM regions WHERE is_valid',
    ),
)
oracle(
    "default_regions",
    with_ctes(
        select=f"""SELECT dc.contig AS region, dc.contig, coalesce(n.n, 0) AS n_calls
        FROM {DEFAULT_CONTIGS_VALUES} LEFT JOIN (SELECT contig, count(*) AS n FROM gt GROUP BY contig) n ON dc.contig = n.contig"""
    ),
)
oracle(
    "region_overlap_scan",
    with_ctes(
        select=f'SELECT file, sample_rank, contig, pos, "end", {KEYS} FROM gt WHERE contig = \'chr20\' AND pos <= 9000 AND "end" >= 5000'
    ),
)
oracle(
    "region_interval_join",
    with_ctes(
        select=f"""SELECT r.region, g.file, g.sample_rank, g.contig, g.pos, g."end", g.l_orderkey, g.l_linenumber
        FROM gt g JOIN (VALUES ('chr1:1-7000', 'chr1', 1, 7000), ('chr1:5000-14000', 'chr1', 5000, 14000),
                               ('chrX', 'chrX', NULL, NULL), ('chrY:2781480', 'chrY', 2781480, NULL),
                               ('chrM:100-200', 'chrM', 100, 200), ('chr20:13994', 'chr20', 13994, NULL))
             AS r(region, contig, b, e)
          ON g.contig = r.contig AND g."end" >= coalesce(r.b, 1) AND g.pos <= coalesce(r.e, 2147483647)"""
    ),
)
oracle(
    "missing_contigs",
    with_ctes(
        select=f"""SELECT dc.contig AS region, dc.contig, CAST(nf.n - coalesce(h.n, 0) AS INTEGER) AS n_files_missing
        FROM {DEFAULT_CONTIGS_VALUES}
        LEFT JOIN (SELECT contig, count(DISTINCT file) AS n FROM gt GROUP BY contig) h ON dc.contig = h.contig,
        (SELECT count(DISTINCT file) AS n FROM gt) nf
        WHERE nf.n - coalesce(h.n, 0) > 0"""
    ),
)

# ------------------------------------------------------------------ VCF text ingest
_NAMES = """
WITH names AS (
    SELECT 'c' || CAST(c_custkey AS VARCHAR) || (['.vcf.gz', '.vcf.bgz', '.bcf', '.vcf', '.txt.gz'])[CAST(c_custkey % 5 AS INTEGER) + 1] AS name,
           'dir' || CAST(c_nationkey AS VARCHAR) || '/' AS dir
    FROM customer
),
labeled AS (
    SELECT dir || name AS path,
        CASE WHEN ends_with(name, '.vcf.gz') THEN substr(name, 1, length(name) - 7)
             WHEN ends_with(name, '.vcf.bgz') THEN substr(name, 1, length(name) - 8)
             WHEN ends_with(name, '.bcf') THEN substr(name, 1, length(name) - 4)
             ELSE name END AS label,
        ends_with(name, '.vcf.gz') OR ends_with(name, '.vcf.bgz') OR ends_with(name, '.bcf') AS supported
    FROM names
)
"""
oracle("file_select", _NAMES + "SELECT regexp_extract(path, '([^/]*)$', 1) AS name, label FROM labeled WHERE supported")
oracle("file_label", _NAMES + "SELECT path, label, supported FROM labeled")

_VCF = """
ct AS (
    SELECT file, contig, pos, "end" AS gend,
        CAST(CASE WHEN alt0 = '<NON_REF>' THEN "end" ELSE pos + length(ref) - 1 END AS INTEGER) AS pend,
        ref, alt0, alt1, sample_rank, gt_text, ploidy, g0, g1, dp, gq, ad0, ad1, ad2,
        gt_text || ':' || coalesce(CAST(dp AS VARCHAR), '.') || ':' || coalesce(CAST(gq AS VARCHAR), '.') || ':' ||
        CASE WHEN dp IS NULL THEN '.' ELSE CAST(ad0 AS VARCHAR) || ',' || CAST(ad1 AS VARCHAR) || ',' || CAST(ad2 AS VARCHAR) END AS call
    FROM gt
),
ctn AS (
    SELECT *, row_number() OVER (PARTITION BY file, contig, pos, gend, ref, alt0, alt1, sample_rank ORDER BY call) AS dup FROM ct
),
vlines AS (SELECT DISTINCT file, contig, pos, gend, pend, ref, alt0, alt1, dup FROM ctn),
width AS (SELECT file, max(sample_rank) AS mr FROM gt GROUP BY file),
grid AS (
    SELECT l.*, CAST(unnest(range(0, w.mr + 1)) AS INTEGER) AS sample_rank FROM vlines l JOIN width w ON l.file = w.file
),
cells AS (
    SELECT g.file, g.contig, g.pos, g.pend, g.ref, g.alt0, g.alt1, g.sample_rank,
           coalesce(c.call, './.') AS call, c.call IS NULL AS filler,
           coalesce(c.gt_text, './.') AS gt_text, coalesce(c.ploidy, 2) AS ploidy, c.g0, c.g1, c.dp, c.gq, c.ad0, c.ad1, c.ad2
    FROM grid g LEFT JOIN ctn c
      ON g.file = c.file AND g.contig = c.contig AND g.pos = c.pos AND g.gend = c.gend AND g.ref = c.ref
     AND g.alt0 = c.alt0 AND g.alt1 = c.alt1 AND g.dup = c.dup AND g.sample_rank = c.sample_rank
)
"""
oracle(
    "vcf_parse_sites",
    with_ctes(
        _VCF,
        select="""SELECT l.file, l.contig, l.pos, l.pend AS "end", l.ref, 2 AS n_alts, l.alt0, l.alt1,
        'GT:DP:GQ:AD' AS format, CAST(w.mr + 1 AS INTEGER) AS n_calls FROM vlines l JOIN width w ON l.file = w.file""",
    ),
)
oracle("vcf_header_samples", with_ctes(select="SELECT DISTINCT file, sample_rank, sample FROM gt"))
oracle("explode_samples", with_ctes(_VCF, select='SELECT file, contig, pos, pend AS "end", ref, sample_rank, call FROM cells'))
oracle(
    "format_lookup",
    with_ctes(
        _VCF,
        select="""SELECT file, contig, pos, sample_rank, gt_text,
        CAST(dp AS VARCHAR) AS dp_text, CAST(gq AS VARCHAR) AS gq_text,
        CASE WHEN filler OR dp IS NULL THEN NULL
             ELSE CAST(ad0 AS VARCHAR) || ',' || CAST(ad1 AS VARCHAR) || ',' || CAST(ad2 AS VARCHAR) END AS ad_text,
        dp, gq FROM cells""",
    ),
)
oracle(
    "gt_parse",
    with_ctes(
        _VCF,
        select="""SELECT file, contig, pos, sample_rank, gt_text, ploidy, g0, g1, gt_text LIKE '%|%' AS phased FROM cells""",
    ),
)
oracle("vcf_count_roundtrip", full_chain(RESULT_SELECT))
oracle(
    "pile_tsv_scan",
    upto_pile(
        "SELECT pos, ref, alt, XX_AC, XX_AC_hom, XX_AC_hemi, XX_n_DP_discarded, XY_AC, XY_AC_hom, XY_AC_hemi, XY_n_DP_discarded, DP FROM pile"
    ),
)

# ------------------------------------------------------------------ sampling
_RECORDS = f"rec AS (SELECT file, sample_rank, contig, pos, {KEYS.replace('l_linenumber', 'l_partkey, l_linenumber')} FROM gt)"
oracle(
    "subsample_per_contig",
    with_ctes(
        _RECORDS,
        """
rep AS (SELECT r.replica, rec.* FROM rec, (SELECT unnest([0, 1]) AS replica) r),
keyed AS (SELECT *, (l_orderkey * 7919 + l_partkey + replica * 104729) % 1000003 AS k FROM rep),
n AS (SELECT replica, contig, count(*) AS n FROM keyed GROUP BY replica, contig),
ranked AS (
    SELECT keyed.*, row_number() OVER (PARTITION BY replica, contig
        ORDER BY k, file, sample_rank, contig, pos, l_orderkey, l_partkey, l_linenumber) AS rk
    FROM keyed
)""",
        select="""SELECT ranked.replica, file, sample_rank, ranked.contig, pos, l_orderkey, l_partkey, l_linenumber
        FROM ranked JOIN n ON ranked.replica = n.replica AND ranked.contig = n.contig
        WHERE rk <= CASE WHEN CAST(floor(n.n * 0.25) AS BIGINT) < 5 THEN least(5, n.n) ELSE CAST(floor(n.n * 0.25) AS BIGINT) END""",
    ),
)
oracle(
    "cap_per_contig",
    with_ctes(
        _RECORDS,
        """
ranked AS (
    SELECT rec.*, row_number() OVER (PARTITION BY contig
        ORDER BY pos, (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey) % 2147483647,
                 file, sample_rank, l_orderkey, l_partkey, l_linenumber) AS rk
    FROM rec
)""",
        select="SELECT file, sample_rank, contig, pos, l_orderkey, l_partkey, l_linenumber FROM ranked WHERE rk <= 1000",
    ),
)

# ------------------------------------------------------------------ streaming
oracle("streaming_counts", full_chain(RESULT_SELECT))

# ------------------------------------------------------------------ tables written and read again
ORACLES["pile_parquet_sink"] = ORACLES["count_job_pile"] = ORACLES["build_pile"]
ORACLES["multi_file_scan"] = ORACLES["count_job"] = ORACLES["allele_counts"]
oracle("count_job_overwrite", full_chain("SELECT *, 0 AS kept_piles FROM counts"))
oracle("list_regions", full_chain("SELECT DISTINCT region FROM counts"))
ORACLES["info_roundtrip"] = ORACLES["dataset_info"]
ORACLES["result_sink"] = ORACLES["finalize"]
ORACLES["bgzf_scan"] = ORACLES["vcf_parse_sites"]
