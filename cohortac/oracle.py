"""DuckDB SQL that recomputes each registered query from the raw test tables.

Written independently of the Spark code: plain CASE logic over the projected calls of
``sources.projection.ORACLE_GENOTYPES_CTE``. Doubles are rounded to 6 places in both
the Spark queries and here.
"""

from __future__ import annotations

from cohortac.constants import DEFAULT_CONTIGS
from cohortac.sources.projection import ORACLE_GENOTYPES_CTE

_DEFAULT_CONTIGS_SQL = ", ".join(f"'{c}'" for c in DEFAULT_CONTIGS)

NONPAR_X = "(pos > 2781479 AND pos < 155701383)"
NONPAR_Y = "((pos > 2781479 AND pos < 56887903) OR pos > 57217415)"

SAMPLES_CTE = """
win AS (
    SELECT file, sample_rank, ploidy, g0, g1 FROM gt
    WHERE contig = 'chrX' AND pos <= 155701382 AND "end" >= 2781480
),
ev AS (
    SELECT file, sample_rank,
        CASE WHEN (ploidy = 1 AND g0 IS NULL) OR (ploidy = 2 AND g0 IS NULL AND g1 IS NULL) THEN NULL
             WHEN ploidy = 2 AND g0 = g1 THEN 'hom'
             WHEN ploidy = 2 THEN 'het'
             WHEN ploidy = 1 AND g0 > 1 THEN 'het' END AS event
    FROM win
),
zc AS (
    SELECT file, sample_rank,
           count(*) FILTER (WHERE event = 'hom') AS n_hom,
           count(*) FILTER (WHERE event = 'het') AS n_het
    FROM ev GROUP BY file, sample_rank
),
hs AS (SELECT DISTINCT file, sample_rank, sample FROM gt),
samples AS (
    SELECT hs.file, hs.sample_rank, hs.sample,
           CAST(coalesce(zc.n_hom, 0) AS BIGINT) AS n_hom,
           CAST(coalesce(zc.n_het, 0) AS BIGINT) AS n_het,
           CASE WHEN coalesce(zc.n_hom, 0) + coalesce(zc.n_het, 0) = 0 THEN 'XX'
                WHEN coalesce(zc.n_het, 0) / (coalesce(zc.n_hom, 0) + coalesce(zc.n_het, 0)) < 0.2 THEN 'XY'
                ELSE 'XX' END AS sex
    FROM hs LEFT JOIN zc ON hs.file = zc.file AND hs.sample_rank = zc.sample_rank
),
info AS (
    SELECT CAST(count(*) FILTER (WHERE sex = 'XX') AS INTEGER) AS n_xx,
           CAST(count(*) FILTER (WHERE sex = 'XY') AS INTEGER) AS n_xy
    FROM samples
)
"""


def calls_cte(min_gq: int = 20, contigs_sql: str = _DEFAULT_CONTIGS_SQL) -> str:
    """Calls that reach classification: region (default contigs), gVCF, chrY and DP rules applied."""
    return f"""
calls_s AS (
    SELECT g.*, s.sex, g.contig AS region FROM gt g
    JOIN samples s ON g.file = s.file AND g.sample_rank = s.sample_rank
    WHERE g.contig IN ({contigs_sql})
      AND g.alt0 <> '<NON_REF>'
      AND (g.contig NOT IN ('chrY', 'Y') OR (s.sex = 'XY' AND {NONPAR_Y.replace('pos', 'g.pos')}))
      AND g.dp IS NOT NULL
),
flags AS (
    SELECT *,
        (sex = 'XY' AND ((contig IN ('chrX', 'X') AND {NONPAR_X}) OR (contig IN ('chrY', 'Y') AND {NONPAR_Y}))) AS hemi,
        coalesce(gq, 0) >= {int(min_gq)} AS gpass
    FROM calls_s
)
"""


def alleles_cte(min_ab: float = 0.2) -> str:
    def alt(a):
        return f"(CASE {a} WHEN 1 THEN alt0 WHEN 2 THEN alt1 END)"

    def ab_ok(a):
        return f"(coalesce(CAST((CASE {a} WHEN 1 THEN ad0 WHEN 2 THEN ad1 END) AS DOUBLE) / nullif(dp, 0), 0.0) > {float(min_ab)})"

    het = "CASE WHEN hemi THEN 1 ELSE 1 END, 0, CASE WHEN hemi THEN 1 ELSE 0 END"
    hom = "CASE WHEN hemi THEN 1 ELSE 2 END, CASE WHEN hemi THEN 0 ELSE 1 END, CASE WHEN hemi THEN 1 ELSE 0 END"
    cols = "region, contig, pos, ref, file, sample_rank, sample, sex, dp, hemi, l_orderkey, l_partkey, l_linenumber"
    return f"""
alleles AS (
    SELECT {cols}, ref AS alt, 0 AS ac, 0 AS ac_hom, 0 AS ac_hemi, gpass AS passed, 'ref' AS kind FROM flags
    WHERE (ploidy = 2 AND ((g0 = 0 AND g1 = 0) OR (g0 IS NULL AND g1 IS NULL))) OR (ploidy = 1 AND (g0 = 0 OR g0 IS NULL))
    UNION ALL
    SELECT {cols}, {alt('g1')}, {het}, gpass AND {ab_ok('g1')}, 'het' FROM flags
    WHERE ploidy = 2 AND g0 = 0 AND g1 IS NOT NULL AND g1 <> 0
    UNION ALL
    SELECT {cols}, {alt('g0')}, {het}, gpass AND {ab_ok('g0')}, 'het' FROM flags
    WHERE ploidy = 2 AND g1 = 0 AND g0 IS NOT NULL AND g0 <> 0
    UNION ALL
    SELECT {cols}, {alt('g0')}, {hom}, gpass, 'hom' FROM flags
    WHERE ploidy = 2 AND g0 = g1 AND g0 <> 0
    UNION ALL
    SELECT {cols}, {alt('g0')}, {het}, gpass AND {ab_ok('g0')}, 'multi' FROM flags
    WHERE ploidy = 2 AND g0 <> g1 AND g0 <> 0 AND g1 <> 0
    UNION ALL
    SELECT {cols}, {alt('g1')}, {het}, gpass AND {ab_ok('g1')}, 'multi' FROM flags
    WHERE ploidy = 2 AND g0 <> g1 AND g0 <> 0 AND g1 <> 0
    UNION ALL
    SELECT {cols}, {alt('g0')}, 1, 0, 1, gpass, 'haploid' FROM flags
    WHERE ploidy = 1 AND g0 <> 0
)
"""


def pile_cte(min_dp: int = 10) -> str:
    def side(sex, v):
        if v == "flag":
            val = f"CASE WHEN dp >= {int(min_dp)} THEN 0 ELSE 1 END"
        else:
            val = f"CASE WHEN dp >= {int(min_dp)} AND passed THEN {v} ELSE 0 END"
        if sex == "XX":
            return f"CAST(CASE WHEN sex = 'XX' THEN {val} ELSE 0 END AS INTEGER)"
        return f"CAST(CASE WHEN sex = 'XX' THEN 0 ELSE {val} END AS INTEGER)"

    return f"""
pile AS (
    SELECT region, contig, pos, ref, alt,
        {side('XX', 'ac')} AS XX_AC, {side('XX', 'ac_hom')} AS XX_AC_hom, {side('XX', 'ac_hemi')} AS XX_AC_hemi,
        {side('XX', 'flag')} AS XX_n_DP_discarded,
        {side('XY', 'ac')} AS XY_AC, {side('XY', 'ac_hom')} AS XY_AC_hom, {side('XY', 'ac_hemi')} AS XY_AC_hemi,
        {side('XY', 'flag')} AS XY_n_DP_discarded,
        dp AS DP, file, sample_rank, sample, sex, passed, kind, hemi, l_orderkey, l_partkey, l_linenumber
    FROM alleles WHERE alt IS DISTINCT FROM '*'
)
"""


COUNTS_CTE = """
counts AS (
    SELECT region, contig, pos, ref, alt,
        CAST(sum(XX_AC) AS INTEGER) AS XX_AC, CAST(sum(XX_AC_hom) AS INTEGER) AS XX_AC_hom,
        CAST(sum(XX_AC_hemi) AS INTEGER) AS XX_AC_hemi,
        CAST(sum(XY_AC) AS INTEGER) AS XY_AC, CAST(sum(XY_AC_hom) AS INTEGER) AS XY_AC_hom,
        CAST(sum(XY_AC_hemi) AS INTEGER) AS XY_AC_hemi,
        CAST(sum(XX_n_DP_discarded) AS INTEGER) AS XX_n_DP_discarded,
        CAST(sum(XY_n_DP_discarded) AS INTEGER) AS XY_n_DP_discarded,
        CAST(count(*) AS INTEGER) AS n_samples,
        CAST(sum(DP) AS DOUBLE) AS DP_sum,
        sum(CAST(DP AS DOUBLE) * CAST(DP AS DOUBLE)) AS DP2_sum
    FROM pile GROUP BY region, contig, pos, ref, alt
)
"""

RESULT_CTE = """
result AS (
    SELECT region, contig, pos, ref, alt,
        CAST((n_xx - XX_n_DP_discarded) * (CASE WHEN contig = 'chrM' THEN 1 WHEN contig = 'chrY' THEN 0 ELSE 2 END) AS INTEGER) AS XX_AN,
        XX_AC, XX_AC_hom, XX_AC_hemi,
        CAST((n_xy - XY_n_DP_discarded) * (CASE WHEN contig = 'chrM' THEN 1 WHEN contig = 'chrY' THEN 1
              WHEN contig = 'chrX' AND pos > 2781479 AND pos < 155701383 THEN 1 ELSE 2 END) AS INTEGER) AS XY_AN,
        XY_AC, XY_AC_hom, XY_AC_hemi,
        DP_sum / n_samples AS DP_mean,
        sqrt(greatest((DP2_sum - 2 * (DP_sum / n_samples) * DP_sum + n_samples * ((DP_sum / n_samples) * (DP_sum / n_samples))) / n_samples, 0.0)) AS DP_std
    FROM counts, info
    WHERE XX_AC > 0 OR XY_AC > 0
)
"""


def with_ctes(*ctes: str, select: str) -> str:
    parts = [ORACLE_GENOTYPES_CTE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + select


def full_chain(select: str, min_dp=10, min_gq=20, min_ab=0.2) -> str:
    return with_ctes(
        SAMPLES_CTE, calls_cte(min_gq), alleles_cte(min_ab), pile_cte(min_dp), COUNTS_CTE, RESULT_CTE, select=select
    )
