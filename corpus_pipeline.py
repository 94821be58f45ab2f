"""Corpus pipeline: language ID, SimHash near-dedup, removal of repeated passages, packing.

Each stage takes (spark, docs, sf_dir), where docs has the columns of documents, and returns a
DataFrame that is written as Parquet and read again as the next stage's docs. All stages but
the last return the columns of their input. Every stage works on all rows of its input; an
empty table gives an empty table, and extra columns are kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.llm import langid, packing, simhash, suffix_dedup
from cohortac.llm.queries import END_OF_DOCUMENT, SEQUENCE_TOKENS, SHINGLE_WORDS, SIMHASH_RADIUS, table
from cohortac.llm.shared import bound_batches, free_name, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (null text, no letter) go."""
    bound_batches(spark)
    stats = langid.fit(docs.where(~langid.is_held_out()))
    lang, score = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = langid.predict(docs, stats, lang_pred=lang, score=score)
    return found.where(F.col(lang) != langid.UNDECIDED).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates the document with the smallest id stays, once. Where rows
    of a group share that id, the one with the smallest hash of the whole row stays (equal rows count as
    one); rows of the same id that belong to another group stay there. Rows without an id stay."""
    bound_batches(spark)
    row = free_name(docs, "row_hash")
    hashed = docs.withColumn(row, F.xxhash64(*[F.col(c) for c in docs.columns]))
    found = simhash.near_duplicates(hashed, words=SHINGLE_WORDS, radius=SIMHASH_RADIUS, keep=(row,))
    stays = found.where("doc_id = component_id").groupBy("fp_group", F.col("doc_id").alias("_stays")).agg(F.min(row).alias("_row"))
    same = (hashed["doc_id"] == stays["_stays"]) & (hashed[row] == stays["_row"])
    named = hashed.join(stays, same, "left_semi").dropDuplicates(["doc_id", row]).drop(row)
    return named.unionByName(docs.where(docs["doc_id"].isNull()))


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that also start earlier are cut from the text; n_chars follows."""
    spans = free_name(docs, "spans")
    found = suffix_dedup.repeated_spans(docs, spans=spans)
    whole = F.size(spans) == 0
    kept = found.withColumn("text", F.when(whole, F.col("text")).otherwise(suffix_dedup.remaining_text(F.col("text"), F.col(spans))))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return kept.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    bound_batches(spark)
    pieces = packing.token_pieces(
        docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, SEQUENCE_TOKENS, END_OF_DOCUMENT
    )
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS, ["doc_id", "piece"])


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("passage_dedup", passage_dedup), ("pack", pack)]

# Code lengths, suffix sorting and packing are not expressible in SQL; tests hold the rows
# against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
