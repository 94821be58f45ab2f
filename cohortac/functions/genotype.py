"""Column expressions for FORMAT fields, genotypes and allelic balance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_TEXT = r"^[+-]?[0-9]+$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_int(text) -> Column:
    """Tolerant integer parse: '.', empty, decimals or junk give NULL instead of an error."""
    t = F.trim(_col(text))
    return F.when(t.rlike(_INT_TEXT), t.try_cast("int"))


def parse_int_list(text) -> Column:
    """Comma list of integers (AD), each element parsed tolerantly; NULL text gives NULL."""
    return F.transform(F.split(_col(text), ","), lambda x: parse_int(x))


def parse_float_as_int(text) -> Column:
    """Integer part of a decimal number (towards zero); NULL for junk, NaN and infinities."""
    number = F.trim(_col(text)).try_cast("double")
    return F.when(F.abs(number) < 2147483648.0, number.cast("int"))


def parse_gt(gt_text, n_alts=None) -> Column:
    """GT text to ARRAY<INT>: '/' and '|' are the same (phase ignored), '.' is NULL.

    With ``n_alts`` an allele index beyond the ALT list becomes NULL (a missing allele).
    A NULL text (no GT key) gives NULL.
    """
    # One separator: a split by a pattern of several compiles it for every value.
    parts = F.split(F.replace(_col(gt_text), F.lit("|"), F.lit("/")), "/")
    arr = F.transform(parts, lambda x: F.when(x.rlike(r"^[0-9]+$"), x.try_cast("int")))
    if n_alts is not None:
        n = _col(n_alts)
        arr = F.transform(arr, lambda a: F.when(a <= n, a))
    return arr


def gt_text(gt) -> Column:
    """ARRAY<INT> genotype back to text with '/' and '.' for missing alleles."""
    return F.array_join(_col(gt).cast("array<string>"), "/", ".")


def allelic_balance(ad, dp, allele_index, index_mode: str = "reference") -> Column:
    """AB of a called allele: AD[a-1] / DP (``index_mode='reference'``, the default, reads the
    entry before the allele), or AD[a] / DP (``index_mode='alt'``). Any failure (missing AD
    entry, DP 0, index outside the list) gives 0.0."""
    a = _col(allele_index)
    offset = a - 1 if index_mode == "reference" else a
    num = F.get(_col(ad), offset.cast("int")).cast("double")
    return F.coalesce(F.try_divide(num, _col(dp).cast("double")), F.lit(0.0))


def gt_class(gt) -> Column:
    """Call class: hom_ref, missing, het, hom_alt, multi_het, half_missing, haploid_ref,
    haploid_missing, haploid_alt, or other (ploidy 0 or >= 3)."""
    g = _col(gt)
    n = F.size(g)
    g0, g1 = F.get(g, 0), F.get(g, 1)
    return (
        F.when((n == 2) & (g0 == 0) & (g1 == 0), F.lit("hom_ref"))
        .when((n == 2) & g0.isNull() & g1.isNull(), F.lit("missing"))
        .when((n == 2) & (g0.isNull() | g1.isNull()), F.lit("half_missing"))
        .when((n == 2) & ((g0 == 0) | (g1 == 0)), F.lit("het"))
        .when((n == 2) & (g0 == g1), F.lit("hom_alt"))
        .when(n == 2, F.lit("multi_het"))
        .when((n == 1) & (g0 == 0), F.lit("haploid_ref"))
        .when((n == 1) & g0.isNull(), F.lit("haploid_missing"))
        .when(n == 1, F.lit("haploid_alt"))
        .otherwise(F.lit("other"))
    )


def het_allele_indices(gt) -> Column:
    """Alt allele indexes that get an AB test: a of 0/a or a/0, both of a1/a2 (a1 != a2)."""
    g = _col(gt)
    n = F.size(g)
    g0, g1 = F.get(g, 0), F.get(g, 1)
    empty = F.array().cast("array<int>")
    return (
        F.when((n == 2) & (g0 == 0) & (g1 != 0), F.array(g1))
        .when((n == 2) & (g1 == 0) & (g0 != 0), F.array(g0))
        .when((n == 2) & (g0 != g1) & (g0 != 0) & (g1 != 0), F.array(g0, g1))
        .otherwise(empty)
    )
