"""Genomic region text: parse, validate, format (1-based, inclusive, open ends allowed)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortac.constants import DEFAULT_CONTIGS, REGION_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_region(text) -> Column:
    """STRUCT<contig, begin, end, is_valid> from 'contig[:begin[-end]]'.

    ``is_valid`` is false for text not matching the pattern and for begin > end; begin/end
    are NULL when absent (and for invalid text).
    """
    t = _col(text)
    ok = t.rlike(REGION_PATTERN)
    contig = F.when(ok, F.regexp_extract(t, r"^(\w+)", 1))
    begin_txt = F.regexp_extract(t, r"^\w+:(\d+)", 1)
    end_txt = F.regexp_extract(t, r"^\w+:\d+-(\d+)$", 1)
    begin = F.when(ok & (begin_txt != ""), begin_txt.try_cast("long"))
    end = F.when(ok & (end_txt != ""), end_txt.try_cast("long"))
    # A coordinate too large for a number is invalid, not absent.
    read = ((begin_txt == "") | begin.isNotNull()) & ((end_txt == "") | end.isNotNull())
    coords_ok = read & F.coalesce(begin <= end, F.lit(True)) & ~(begin.isNull() & end.isNotNull())
    return F.struct(
        contig.alias("contig"),
        begin.alias("begin"),
        end.alias("end"),
        (ok & coords_ok).alias("is_valid"),
    )


def invalid_reason(text) -> Column:
    """Why a region text is invalid ('format', 'coordinate' or 'begin_after_end'); NULL if it is valid."""
    t, r = _col(text), parse_region(text)
    too_large = r["begin"].isNull() & t.contains(":") | r["end"].isNull() & t.contains("-")
    return F.when(~t.rlike(REGION_PATTERN), F.lit("format")).when(~r["is_valid"], F.when(too_large, F.lit("coordinate")).otherwise(F.lit("begin_after_end")))


def format_region(contig, begin, end) -> Column:
    """Region back to text: contig, then ':begin' when set, then '-end' when set."""
    c, b, e = _col(contig), _col(begin), _col(end)
    return F.concat(
        c,
        F.coalesce(F.concat(F.lit(":"), b.cast("string")), F.lit("")),
        F.coalesce(F.concat(F.lit("-"), e.cast("string")), F.lit("")),
    )


def begin0(begin) -> Column:
    """1-based begin to the 0-based start used by index queries (NULL stays NULL)."""
    return _col(begin) - 1


def split_region_list(text) -> Column:
    """Comma-separated region list to an array of region texts."""
    return F.split(_col(text), ",")


REGION_SCHEMA = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("contig", T.StringType()),
        T.StructField("begin", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def regions_frame(spark: SparkSession, regions: list[str] | str | None = None, strict: bool = True) -> DataFrame:
    """Regions as a small DataFrame (region, contig, begin, end); ``None`` gives the default contigs.

    With ``strict`` an invalid region text raises when the frame is evaluated; otherwise
    invalid rows are dropped. Duplicate regions collapse to one.
    """
    if regions is None:
        texts = list(DEFAULT_CONTIGS)
    elif isinstance(regions, str):
        texts = [regions]
    else:
        texts = list(regions)
    # One literal whatever the number of regions, taken apart on the JVM side.
    raw = spark.range(1).select(F.explode(split_region_list(F.lit(",".join(texts)))).alias("text"))
    p = raw.select("text", parse_region("text").alias("r"))
    if strict:
        p = p.where(
            F.when(~F.col("r.is_valid"), F.raise_error(F.concat(F.lit("Invalid region: "), F.col("text")))).otherwise(
                F.lit(True)
            )
        )
    else:
        p = p.where(F.col("r.is_valid"))
    return p.select(
        format_region("r.contig", "r.begin", "r.end").alias("region"),
        F.col("r.contig").alias("contig"),
        F.col("r.begin").alias("begin"),
        F.col("r.end").alias("end"),
    ).distinct()
