"""Column expressions about contigs and pseudo-autosomal regions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortac.constants import (
    CHRX_NAMES,
    CHRY_NAMES,
    FINALIZE_CHRM,
    FINALIZE_CHRX,
    FINALIZE_CHRY,
    PAR1_END,
    PAR2_X_BEGIN,
    PAR2_Y_BEGIN,
    PAR2_Y_END,
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_chrx(contig) -> Column:
    return _col(contig).isin(*CHRX_NAMES)


def is_chry(contig) -> Column:
    return _col(contig).isin(*CHRY_NAMES)


def non_par_x(pos) -> Column:
    """chrX outside both PARs: strictly between the PAR1 end and the PAR2 begin."""
    p = _col(pos)
    return (p > F.lit(PAR1_END)) & (p < F.lit(PAR2_X_BEGIN))


def non_par_y(pos) -> Column:
    """chrY outside the PARs: between PAR1 and PAR2, or after the PAR2 end."""
    p = _col(pos)
    return ((p > F.lit(PAR1_END)) & (p < F.lit(PAR2_Y_BEGIN))) | (p > F.lit(PAR2_Y_END))


def par_class(contig, pos) -> Column:
    """Label a position: 'nonpar_x', 'nonpar_y', 'par_x', 'par_y' or 'autosomal'."""
    c, p = _col(contig), _col(pos)
    return (
        F.when(is_chrx(c) & non_par_x(p), F.lit("nonpar_x"))
        .when(is_chrx(c), F.lit("par_x"))
        .when(is_chry(c) & non_par_y(p), F.lit("nonpar_y"))
        .when(is_chry(c), F.lit("par_y"))
        .otherwise(F.lit("autosomal"))
    )


def xx_ploidy(contig) -> Column:
    """Copies per XX sample used for AN: chrM 1, chrY 0, otherwise 2."""
    c = _col(contig)
    return F.when(c == FINALIZE_CHRM, F.lit(1)).when(c == FINALIZE_CHRY, F.lit(0)).otherwise(F.lit(2))


def xy_ploidy(contig, pos) -> Column:
    """Copies per XY sample used for AN: chrM 1, chrY 1, chrX 1 off the PARs else 2, otherwise 2."""
    c, p = _col(contig), _col(pos)
    return (
        F.when(c == FINALIZE_CHRM, F.lit(1))
        .when(c == FINALIZE_CHRY, F.lit(1))
        .when((c == FINALIZE_CHRX) & non_par_x(p), F.lit(1))
        .otherwise(F.lit(2))
    )


def normalize_contig(contig) -> Column:
    """Contig names in the 'chr' spelling: 1..22, X, Y -> chr1..chr22, chrX, chrY; M and MT -> chrM.
    Other names (and names already spelled with 'chr') are unchanged."""
    c = _col(contig)
    return (
        F.when(c.isin("M", "MT"), F.lit("chrM"))
        .when(c.rlike(r"^([1-9]|1[0-9]|2[0-2]|X|Y)$"), F.concat(F.lit("chr"), c))
        .otherwise(c)
    )
