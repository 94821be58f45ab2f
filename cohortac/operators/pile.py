"""From genotype calls to the per-allele pile: filters, call classification, allele rows.

Every step is a column expression or a map-side filter; the only row-generating step is
``explode`` over an array of at most two allele structs per call, so the whole pile is
one whole-stage-codegen pipeline between the scan and the count aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.constants import (
    DEFAULT_MIN_AB,
    DEFAULT_MIN_DP,
    DEFAULT_MIN_GQ,
    GVCF_BLOCK_ALT,
    HEMI_COUNTS,
    HET_COUNTS,
    HOM_ALT_COUNTS,
    SPANNING_DELETION,
    ZERO_COUNTS,
)
from cohortac.functions.genome import is_chrx, is_chry, non_par_x, non_par_y
from cohortac.functions.genotype import allelic_balance
from cohortac.session import DEFAULT_BROADCAST_BYTES, broadcast_if_bounded

_MODES = ("error", "drop")

SAMPLE_BYTES = 64  # of a sample's sex in a broadcast array, with its share of the row


def _check_mode(on_unsupported: str) -> None:
    if on_unsupported not in _MODES:
        raise ValueError(f"on_unsupported must be one of {_MODES}, not {on_unsupported!r}")


def join_sample_sex(genotypes: DataFrame, samples: DataFrame, max_broadcast_rows: int | None = None) -> DataFrame:
    """Attach each call's sample sex by (file, sample_rank).

    The samples table is broadcast only when its counted size is within the bound; a
    cohort too large for that falls back to a shuffle join.
    """
    s = broadcast_if_bounded(samples.select("file", "sample_rank", "sex"), max_broadcast_rows)
    return genotypes.join(s, ["file", "sample_rank"], "inner")


def has_no_alt(alts="alts") -> Column:
    a = F.col(alts) if isinstance(alts, str) else alts
    return a.isNull() | (F.size(a) == 0)


def drop_gvcf_blocks(df: DataFrame, on_unsupported: str = "error") -> DataFrame:
    """Drop reference blocks (first ALT is <NON_REF>). A record without any ALT is an error
    (``on_unsupported='error'``) or dropped (``'drop'``).

    The error sits in a generator, which the optimizer does not move below a join: only records
    that the steps before this one (the region join) let through can raise it.
    """
    _check_mode(on_unsupported)
    is_block = F.get(F.col("alts"), 0).eqNullSafe(F.lit(GVCF_BLOCK_ALT))
    if on_unsupported == "drop":
        return df.where(~has_no_alt() & ~is_block)
    message = F.concat(F.lit("Record without ALT at "), F.col("contig"), F.lit(":"), F.col("pos").cast("string"))
    checked = F.when(has_no_alt(), F.raise_error(message)).otherwise(F.array(F.lit(True)))
    return df.where(has_no_alt() | ~is_block).select("*", F.explode(checked).alias("_checked")).drop("_checked")


def join_file_sexes(sites: DataFrame, samples: DataFrame, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Attach to each site its file's sample sexes in header order (``sexes``): one row per file is
    joined, never a row per call. Broadcast only if the counted samples fit the bound."""
    per_file = samples.groupBy("file").agg(F.transform(F.array_sort(F.collect_list(F.struct("sample_rank", "sex"))), lambda x: x["sex"]).alias("sexes"))
    if samples.count() * SAMPLE_BYTES <= max_broadcast_bytes:
        per_file = F.broadcast(per_file)
    return sites.join(per_file, "file")


def chry_filter(df: DataFrame) -> DataFrame:
    """chrY: XX calls are skipped, XY calls only kept outside the PARs."""
    return df.where(~is_chry("contig") | ((F.col("sex") == "XY") & non_par_y("pos")))


def missing_dp_filter(df: DataFrame) -> DataFrame:
    """Calls without an integer DP are not counted at all."""
    return df.where(F.col("dp").isNotNull())


def gq_pass(min_gq: int = DEFAULT_MIN_GQ) -> Column:
    """PASS flag of a call: GQ (missing = 0) >= min_GQ."""
    return F.coalesce(F.col("gq"), F.lit(0)) >= F.lit(int(min_gq))


def hemizygous(contig="contig", pos="pos", sex="sex") -> Column:
    """XY calls on chrX or chrY outside the PARs are counted as single copies."""
    c, p, s = F.col(contig), F.col(pos), F.col(sex)
    return (s == "XY") & ((is_chrx(c) & non_par_x(p)) | (is_chry(c) & non_par_y(p)))


def _triple(t) -> list[Column]:
    return [F.lit(t[0]), F.lit(t[1]), F.lit(t[2])]


def _allele(alt: Column, counts, passed: Column) -> Column:
    if isinstance(counts, tuple):
        ac, hom, hemi = _triple(counts)
    else:
        ac, hom, hemi = counts
    return F.struct(
        alt.alias("alt"),
        ac.cast("int").alias("ac"),
        hom.cast("int").alias("ac_hom"),
        hemi.cast("int").alias("ac_hemi"),
        passed.alias("passed"),
    )


def _switch(cond: Column, a, b) -> list[Column]:
    return [F.when(cond, x).otherwise(y) for x, y in zip(_triple(a), _triple(b))]


def allele_rows(
    min_gq: int = DEFAULT_MIN_GQ,
    min_ab: float = DEFAULT_MIN_AB,
    ab_index: str = "reference",
    on_unsupported: str = "error",
) -> Column:
    """ARRAY<STRUCT<alt, ac, ac_hom, ac_hemi, passed>> for one call.

    Branch order: hom-ref or fully missing (diploid) -> ref row with zero counts; het
    (0/a or a/0) -> AB-tested a; equal alleles -> hom-alt; two different alts -> two
    AB-tested het rows, each with its own AB; haploid 0 or missing -> ref row; haploid
    alt -> single-copy counts without AB test; other ploidies -> no rows. Half-missing
    diploid calls are an error (default) or give no rows.
    """
    _check_mode(on_unsupported)
    gt, alts, ref = F.col("gt"), F.col("alts"), F.col("ref")
    n = F.size(gt)
    g0, g1 = F.get(gt, 0), F.get(gt, 1)
    hemi = F.col("hemi")
    passed = gq_pass(min_gq)

    def alt_of(a: Column) -> Column:
        return F.get(alts, (a - 1).cast("int"))

    def ab_ok(a: Column) -> Column:
        return allelic_balance(F.col("ad"), F.col("dp"), a, ab_index) > F.lit(float(min_ab))

    het_t = _switch(hemi, HEMI_COUNTS, HET_COUNTS)
    hom_t = _switch(hemi, HEMI_COUNTS, HOM_ALT_COUNTS)
    ref_row = F.array(_allele(ref, ZERO_COUNTS, passed))

    def het(a: Column) -> Column:
        return _allele(alt_of(a), het_t, passed & ab_ok(a))

    diploid = n == 2
    both = g0.isNotNull() & g1.isNotNull()
    rows = (
        F.when(diploid & (((g0 == 0) & (g1 == 0)) | (g0.isNull() & g1.isNull())), ref_row)
        .when(diploid & (g0 == 0) & g1.isNotNull(), F.array(het(g1)))
        .when(diploid & (g1 == 0) & g0.isNotNull(), F.array(het(g0)))
        .when(diploid & both & (g0 == g1), F.array(_allele(alt_of(g0), hom_t, passed)))
        .when(diploid & both, F.array(het(g0), het(g1)))
    )
    if on_unsupported == "error":
        rows = rows.when(
            diploid,
            F.raise_error(F.concat(F.lit("Half-missing genotype at "), F.col("contig"), F.lit(":"), F.col("pos").cast("string"))),
        )
    rows = rows.when((n == 1) & ((g0 == 0) | g0.isNull()), ref_row).when(
        n == 1, F.array(_allele(alt_of(g0), HEMI_COUNTS, passed))
    )
    # No branch (ploidy 0 or >= 3): NULL, which explode turns into no rows.
    return rows


def explode_alleles(df: DataFrame, **kw) -> DataFrame:
    """One row per called allele (two for a multi-allelic het), with its counts and pass flag."""
    cols = [c for c in df.columns if c not in ("hemi",)]
    return (
        df.withColumn("hemi", hemizygous())
        .select(*cols, "hemi", F.explode(allele_rows(**kw)).alias("a"))
        .select(*cols, "hemi", "a.alt", "a.ac", "a.ac_hom", "a.ac_hemi", "a.passed")
    )


def drop_spanning_deletion(df: DataFrame) -> DataFrame:
    """Spanning-deletion alleles ('*') are not counted."""
    return df.where(~F.col("alt").eqNullSafe(F.lit(SPANNING_DELETION)))


def dp_outcome(min_dp: int = DEFAULT_MIN_DP) -> list[Column]:
    """(AC, AC_hom, AC_hemi, n_DP_discarded) after the depth rule: DP >= min_DP and passed ->
    the allele's counts; DP >= min_DP and not passed -> zeros (AN unchanged); DP < min_DP ->
    zeros and the discard flag."""
    deep = F.col("dp") >= F.lit(int(min_dp))
    ok = deep & F.col("passed")
    return [
        F.when(ok, F.col("ac")).otherwise(F.lit(0)),
        F.when(ok, F.col("ac_hom")).otherwise(F.lit(0)),
        F.when(ok, F.col("ac_hemi")).otherwise(F.lit(0)),
        F.when(deep, F.lit(0)).otherwise(F.lit(1)),
    ]


def sex_split(df: DataFrame, min_dp: int = DEFAULT_MIN_DP, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pile rows: the call's four numbers go to the XX_* or XY_* side, the other side is zero."""
    vals = dp_outcome(min_dp)
    names = ["AC", "AC_hom", "AC_hemi", "n_DP_discarded"]
    is_xx = F.col("sex") == "XX"
    xx = [F.when(is_xx, v).otherwise(F.lit(0)).cast("int").alias(f"XX_{n}") for v, n in zip(vals, names)]
    xy = [F.when(is_xx, F.lit(0)).otherwise(v).cast("int").alias(f"XY_{n}") for v, n in zip(vals, names)]
    return df.select(
        "region", "contig", "pos", "ref", "alt", *xx, *xy, F.col("dp").cast("int").alias("DP"), *keep
    )


def build_pile(
    genotypes: DataFrame,
    samples: DataFrame,
    min_dp: int = DEFAULT_MIN_DP,
    min_gq: int = DEFAULT_MIN_GQ,
    min_ab: float = DEFAULT_MIN_AB,
    ab_index: str = "reference",
    on_unsupported: str = "error",
    max_broadcast_rows: int | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Genotype calls with a ``region`` column -> pile rows (one per sample and called allele).

    ``genotypes`` needs region, contig, pos, ref, alts, file, sample_rank, gt, dp, gq, ad;
    ``samples`` needs file, sample_rank, sex.
    """
    g = drop_gvcf_blocks(genotypes, on_unsupported)
    g = join_sample_sex(g, samples, max_broadcast_rows)
    return pile_of_calls(g, min_dp, min_gq, min_ab, ab_index, on_unsupported, keep)


def pile_of_calls(
    calls: DataFrame,
    min_dp: int = DEFAULT_MIN_DP,
    min_gq: int = DEFAULT_MIN_GQ,
    min_ab: float = DEFAULT_MIN_AB,
    ab_index: str = "reference",
    on_unsupported: str = "error",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Calls with region and sex, without gVCF blocks -> pile rows."""
    g = missing_dp_filter(chry_filter(calls))
    alleles = explode_alleles(g, min_gq=min_gq, min_ab=min_ab, ab_index=ab_index, on_unsupported=on_unsupported)
    alleles = drop_spanning_deletion(alleles)
    return sex_split(alleles, min_dp, keep)
