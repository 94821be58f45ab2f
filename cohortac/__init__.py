"""Cohort allele counting on Spark: VCF calls -> sex inference -> per-variant allele counts
split by sex -> allele numbers and depth statistics, as lazy DataFrame plans."""

__version__ = "0.1.0"
