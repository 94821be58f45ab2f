"""Registered queries: each applies one operator, with production parameters, to its whole
table and derives the columns of the result contract."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortac.llm import byte_bpe, conversations, embedding_dedup, langid, lm_score, mixing, packing, simhash, suffix_dedup, token_counts, topk, warc, whitening

SHINGLE_WORDS = 3
SIMHASH_RADIUS = 3
TOP_K = 5
COSINE = 0.93
SEQUENCE_TOKENS = 1024
END_OF_DOCUMENT = 2
MIX_WEIGHTS, MIX_EPOCHS = (1, 2, 3), 3
COMPONENTS = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=SHINGLE_WORDS, radius=SIMHASH_RADIUS)
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("id % 50 = 0"), TOP_K)


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), COSINE)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    stats = langid.fit(docs.where(~langid.is_held_out()))
    return langid.predict(docs.withColumn("held_out", langid.is_held_out()), stats).drop("text", "lang")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, SEQUENCE_TOKENS, END_OF_DOCUMENT)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), SEQUENCE_TOKENS, ["doc_id", "piece"])


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lm_score.scores(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", F.round(F.col("score") / F.col("n_words"), 4).alias("mean_log_score"))


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = suffix_dedup.repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(suffix_dedup.remaining(F.col("text"), F.col("spans")), 256).alias("kept_sha256"),
    )


def page_records(pages: DataFrame) -> DataFrame:
    """Archive records of the pages: a full response for every page, and a revisit of it by another
    spelling of its URL. By page id some revisits come before the response, carry another
    validator or only a modification date."""
    p, body = F.col("page_id"), F.coalesce("html", F.lit(""))
    tag = F.concat(F.lit('"'), F.md5(body), F.lit('"'))
    day = F.concat(F.lit("day "), F.pmod(p, F.lit(28)).cast("string"))
    tagged = F.pmod(p, F.lit(5)) != 0
    full = F.struct(
        (4 * p).alias("record_id"),
        F.col("url").alias("url"),
        (10 * p + F.when(F.pmod(p, F.lit(11)) == 0, 8).otherwise(0)).alias("ts"),
        F.lit("response").alias("kind"),
        F.map_filter(
            F.create_map(
                F.lit("ETag"), F.when(tagged, tag), F.lit("Last-Modified"), day, F.lit("Content-Type"), F.lit("text/html"),
                F.lit("Content-Length"), F.octet_length(body).cast("string"), F.lit("Cache-Control"), F.lit("max-age=60"),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("headers"),
        body.alias("body"),
    )
    again = F.struct(
        (4 * p + 1).alias("record_id"),
        F.concat(F.regexp_replace(F.regexp_replace(F.col("url"), "#.*$", ""), "^http://", "https://"), F.lit("#again")).alias("url"),
        (10 * p + 5).alias("ts"),
        F.lit("revisit").alias("kind"),
        F.map_filter(
            F.create_map(
                F.lit("etag"), F.when(tagged, F.when(F.pmod(p, F.lit(7)) == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))),
                F.lit("last-modified"), F.when(F.pmod(p, F.lit(10)) == 0, F.lit("day 99")).otherwise(day),
                F.lit("content-length"), F.lit("0"), F.lit("cache-control"), F.lit("max-age=600"), F.lit("age"), F.lit("0"),
            ),
            lambda _, v: v.isNotNull(),
        ).alias("headers"),
        F.lit(None).cast("string").alias("body"),
    )
    return pages.select(F.explode(F.array(full, again)).alias("r")).select("r.*")


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve_revisits(page_records(table(spark, sf_dir, "pages")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return found.select(
        "record_id", "status", "refers_to", F.octet_length("body").cast("long").alias("n_bytes"), F.md5("body").alias("body_md5"), F.concat_ws("\n", lines).alias("headers")
    )


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = byte_bpe.round_trip(docs, ranks, pattern)
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with damage done by a hash of conversation and turn: a row is left out (``absent``),
    emptied, loses its sentence ends, comes twice or becomes a user's."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.pmod(F.crc32(place), F.lit(20))
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    times = F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    done = rows.select("conv_id", "turn", (kind == 0).alias("absent"), F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"), text.alias("text"), times.alias("time"))
    return done.drop("time")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(damaged(table(spark, sf_dir, "conversations")), absent=F.col("absent"))


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=MIX_WEIGHTS, max_epochs=MIX_EPOCHS)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), COMPONENTS)
    return found.withColumn("deviation", F.col("deviation").cast("long"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash_dedup, op2_exact_top_k, op3_embedding_dedup, op4_token_counts, op5_language_id, op6_best_fit_packing, op7_lm_score, op8_suffix_array_dedup, op9_warc_revisits, op10_byte_bpe, op11_conversation_repair, op12_source_mixing, op13_embedding_whitening)
}

ORACLES: dict[str, str] = {
    "op2_exact_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id,
           CAST(list_sum(list_transform(range(1, len(q.vec) + 1), lambda i: q.vec[i] * r.vec[i])) AS BIGINT) AS score
    FROM v q JOIN v r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.vec) = len(r.vec)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
""",
    "op7_lm_score": r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w
    FROM documents
), n AS (
    SELECT doc_id, CAST(sum(len(w)) AS BIGINT) AS n_words FROM d GROUP BY doc_id
), total AS (
    SELECT sum(n_words) AS t FROM n
), occ AS (
    SELECT doc_id, i, w[i] AS w1, CASE WHEN i > 1 THEN w[i - 1] END AS w2, CASE WHEN i > 2 THEN w[i - 2] END AS w3
    FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d)
), g1 AS (  -- of each document's n-grams: how often all other documents have them
    SELECT doc_id, w1, sum(count(*)) OVER (PARTITION BY w1) - count(*) AS c FROM occ GROUP BY doc_id, w1
), g2 AS (
    SELECT doc_id, w2, w1, sum(count(*)) OVER (PARTITION BY w2, w1) - count(*) AS c FROM occ WHERE i > 1 GROUP BY doc_id, w2, w1
), g3 AS (
    SELECT doc_id, w3, w2, w1, sum(count(*)) OVER (PARTITION BY w3, w2, w1) - count(*) AS c FROM occ WHERE i > 2 GROUP BY doc_id, w3, w2, w1
), scored AS (
    SELECT o.doc_id, CASE
        WHEN t.c > 0 THEN ln(CAST(t.c AS DOUBLE) / CAST(bh.c AS DOUBLE))
        WHEN b.c > 0 THEN ln(CAST(b.c AS DOUBLE) / CAST(uh.c AS DOUBLE)) + CASE WHEN o.i > 2 THEN ln(0.4) ELSE 0 END
        ELSE ln(CAST(greatest(u.c, 1) AS DOUBLE) / CAST(greatest(total.t - n.n_words, 1) AS DOUBLE)) + least(o.i - 1, 2) * ln(0.4) END AS s
    FROM occ o JOIN n ON n.doc_id = o.doc_id CROSS JOIN total
    JOIN g1 u ON u.doc_id = o.doc_id AND u.w1 = o.w1
    LEFT JOIN g1 uh ON uh.doc_id = o.doc_id AND uh.w1 = o.w2
    LEFT JOIN g2 b ON b.doc_id = o.doc_id AND b.w2 = o.w2 AND b.w1 = o.w1
    LEFT JOIN g2 bh ON bh.doc_id = o.doc_id AND bh.w2 = o.w3 AND bh.w1 = o.w2
    LEFT JOIN g3 t ON t.doc_id = o.doc_id AND t.w3 = o.w3 AND t.w2 = o.w2 AND t.w1 = o.w1
)
SELECT n.doc_id, n.n_words, round(t.s / n.n_words, 4) AS mean_log_score
FROM n LEFT JOIN (SELECT doc_id, sum(s) AS s FROM scored GROUP BY doc_id) t ON t.doc_id = n.doc_id
""",
    "op9_warc_revisits": r"""
WITH p AS (
    SELECT page_id AS p, url, coalesce(html, '') AS body, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id % 28) AS day FROM pages
), canon AS (
    SELECT *, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM p
), parts AS (
    SELECT *,
        regexp_replace(regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^(www|m)\.', ''), ':(80|443)$', '') AS host,
        regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
        list_sort(list_filter(string_split(regexp_extract(rest, '\?(.*)$', 1), '&'), lambda q: q <> '' AND NOT regexp_matches(q, '^(utm_[a-z]+|ref)='))) AS params
    FROM canon
), u AS (
    SELECT *, host || path || CASE WHEN len(params) > 0 THEN '?' || array_to_string(params, '&') ELSE '' END AS curl FROM parts
), f AS (
    SELECT 4 * p AS record_id, curl, 10 * p + CASE WHEN p % 11 = 0 THEN 8 ELSE 0 END AS ts, body, octet_length(encode(body)) AS n,
           CASE WHEN p % 5 <> 0 THEN tag END AS tag, day
    FROM u
), r AS (
    SELECT 4 * p + 1 AS record_id, curl, 10 * p + 5 AS ts,
           CASE WHEN p % 5 <> 0 THEN CASE WHEN p % 7 = 0 THEN '"other"' ELSE 'W/' || tag END END AS tag,
           CASE WHEN p % 10 = 0 THEN 'day 99' ELSE day END AS day
    FROM u
), j AS (
    SELECT r.*, f.record_id AS refers_to, f.body, f.n, f.tag AS f_tag, f.day AS f_day,
           row_number() OVER (PARTITION BY r.record_id ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) AS place
    FROM r LEFT JOIN f ON f.curl = r.curl AND f.ts < r.ts
), s AS (
    SELECT *, CASE
        WHEN refers_to IS NULL THEN 'orphan'
        WHEN coalesce(regexp_replace(tag, '^W/', '') = regexp_replace(f_tag, '^W/', ''), day = f_day) THEN 'resolved'
        ELSE 'mismatch' END AS status
    FROM j WHERE place = 1
)
SELECT record_id, status, refers_to,
       CASE WHEN status = 'resolved' THEN n END AS n_bytes,
       CASE WHEN status = 'resolved' THEN md5(body) END AS body_md5,
       CASE WHEN status = 'resolved' THEN
           concat_ws(chr(10), 'age: 0', 'cache-control: max-age=600', 'content-length: ' || n, 'content-type: text/html', 'etag: ' || coalesce(tag, f_tag), 'last-modified: ' || day)
       ELSE concat_ws(chr(10), 'age: 0', 'cache-control: max-age=600', 'content-length: 0', 'etag: ' || tag, 'last-modified: ' || day) END AS headers
FROM s
""",
    "op12_source_mixing": r"""
WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
           md5(concat_ws(':', '42', CAST(doc_id AS VARCHAR))) AS key
    FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w, 3 * source_size AS most FROM s
), l AS (  -- by limit for each unit of weight: the sources that come before this one are at their limits
    SELECT *, sum(source_size) OVER () AS t, sum(w) OVER () AS ws,
           coalesce(sum(most) OVER (ORDER BY most / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
           coalesce(sum(w) OVER (ORDER BY most / w, w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
    FROM w
), c AS (
    SELECT *, w * (t - held) >= most * (ws - used) AS capped FROM l
), r AS (
    SELECT max(t) - coalesce(sum(most) FILTER (WHERE capped), 0) AS rest, max(ws) - coalesce(sum(w) FILTER (WHERE capped), 0) AS shares FROM c
), g AS (
    SELECT source, source_size, CASE WHEN capped THEN CAST(most AS DOUBLE) ELSE CAST(w * rest AS DOUBLE) / CAST(shares AS DOUBLE) END AS target FROM c, r
), p AS (
    SELECT d.doc_id, d.size, g.source_size, g.target, CAST(floor(g.target + 0.5) AS BIGINT) AS budget,
           CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id NULLS FIRST, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
), e AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p
)
SELECT doc_id, size, source_size, target, epochs * size + greatest(0, least(size, budget - epochs * source_size - before)) AS taken FROM e
""",
}
