"""Language ID, exact top-k, LM scores, WARC revisits and the pipeline."""

import math
import os
import random
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
import frames
from frames import no_documents, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from cohortac.llm import langid, lm_score, queries, simhash, topk, warc
from cohortac.session import checkpoint_dir
from test_dedup import plain_removed
from test_tokens import check_packing

SF, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def oracle(name, **tables):
    con = duckdb.connect()
    for table, path in tables.items():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con.execute(queries.ORACLES[name]).fetchall()


def plain_code_length(stats, text):
    """PPM by its definition, byte by byte."""
    contexts = [{} for _ in range(langid.ORDER + 1)]
    for gram, n in zip(np.frombuffer(stats[0], "<u4").tolist(), np.frombuffer(stats[1], "<i8").tolist()):
        b = gram.to_bytes(4, "big")
        for k in range(langid.ORDER + 1):
            at = contexts[k].setdefault(b[3 - k : 3], {})
            at[b[3]] = at.get(b[3], 0) + n

    def p(k, context, byte):
        shorter = 1 / 256 if k == 0 else p(k - 1, context, byte)
        at = contexts[k].get(context[3 - k :])
        return shorter if at is None else (at.get(byte, 0) + len(at) * shorter) / (sum(at.values()) + len(at))

    data = b"\0\0\0" + text.encode()
    return -sum(math.log2(p(3, data[i - 3 : i], data[i])) for i in range(3, len(data)))


def test_code_lengths_are_exact():
    stats = {}
    for lang, texts in {"a": ["hello there", "hello you", "the end"], "b": ["ça va bien", "été"]}.items():
        row = langid.count_grams(pd.DataFrame({"lang": lang, "text": texts})).iloc[0]
        stats[lang] = (row.grams, row.counts)
    tables = langid.Tables.build(stats)
    for text in ("hello", "ça va", "漢字 Zq\x05", "x", "the été " * 50):
        want = [plain_code_length(stats[k], text) for k in tables.langs]
        assert np.allclose(tables.code_lengths(text), want, rtol=1e-5)
        lang, score = tables.predict(text)
        assert lang == tables.langs[int(np.argmin(want))] and 0 < score <= 1
    n = len(tables.bits) // tables.rows
    seen = np.exp2(-tables.bits.reshape(tables.rows, n, 2).astype(float))
    missing = 256 - (n - 1)  # the last class stands for every byte that was never seen
    assert np.allclose(seen[:, :-1].sum(1) + missing * seen[:, -1], 1, atol=1e-5)


def test_op5_query_held_out_accuracy(spark):
    rows = queries.op5_language_id(spark, SF01).collect()
    lang = {r.doc_id: r.lang for r in queries.table(spark, SF01, "documents").collect()}
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op5_rows(spark):
    docs = odd_documents(spark)
    found = langid.predict(docs, langid.fit(docs)).collect()
    assert {r.doc_id for r in found if r.lang_pred == "und"} == {5, 6, 7, 8, None}
    assert all(r.score == 0 for r in found if r.lang_pred == "und") and all(r.guess == "x" for r in found)
    assert len([r for r in found if r.doc_id == 10 and r.lang_pred == "en"]) == 2
    assert langid.fit(no_documents(spark)) == {}
    assert {r.lang_pred for r in langid.predict(docs, {}).collect()} == {"und"}
    assert langid.predict(no_documents(spark), langid.fit(docs)).count() == 0


def test_op5_learns_a_language_of_many_copies(spark):
    texts = [f"some words of text number {i}" for i in range(200)]
    others = spark.createDataFrame([(t, "en") for t in texts] + [(None, "en"), ("sin etiqueta", None), ("una frase", "es")], "text string, lang string")
    copies = spark.range(60_000).selectExpr("'the same text again' AS text", "'en' AS lang")
    stats = langid.fit(copies.union(others))
    want = langid.count_grams(pd.DataFrame({"lang": "en", "text": [*texts, "the same text again"]})).iloc[0]
    assert list(stats) == ["en", "es"] and stats["en"] == (want.grams, want.counts)


def plain_top(rows, queried, k):
    out = []
    for qid, q in queried:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qid and len(v) == len(q))
        out += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 40])
def test_impact_ordered_search_is_exact(spark, spread):
    rng = np.random.default_rng(spread)
    rows = [(i, rng.integers(-100, 100, 6).tolist() if i % spread else [90, -80, 5, 5, 5, 5]) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, vec array<long>")
    found = topk.top_k(df, df.where("id % 50 = 0"), 5, shard_rows=130, query_rows=3).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found)) == plain_top(rows, [r for r in rows if r[0] % 50 == 0], 5)


def test_search_stops_early_on_proof():
    rng = np.random.default_rng(1)
    values = rng.integers(-5, 5, (3000, 8))
    values[:10] += 200
    index = topk.ImpactIndex(values)
    members = index.possible(np.full(8, 3), 5, np.zeros(0, np.int64))
    assert set(np.argsort(-(values @ np.full(8, 3)))[:5]) <= set(members.tolist()) and len(members) <= topk.FEWEST
    assert index.read < 0.5


def test_search_on_the_given_vectors_reads_less_than_all(spark):
    """Queries stop on proof, well before the last segment, with few rows left to score."""
    rows = topk.quantised(queries.table(spark, "/root/testdata/sf0.1", "embeddings")).orderBy("id").collect()
    values = np.array([r.vec for r in rows])
    index, read, left = topk.ImpactIndex(values), [], []
    for row in range(0, len(values), 50):
        members = index.possible(values[row], 5, np.array([row]))
        scores = values @ values[row]
        others = np.delete(np.arange(len(values)), row)
        assert set(others[np.argsort(-scores[others], kind="stable")[:5]]) <= set(members.tolist()) and row not in members
        read.append(index.read)
        left.append(len(members))
    assert max(read) < 1 and np.median(read) < 0.85 and np.median(left) <= topk.FEWEST


@pytest.mark.parametrize("size", [1, 10**6, 10**12])
def test_bounds_hold_for_any_size_of_values(size):
    rng = np.random.default_rng(size % 97)
    values = (rng.standard_normal((500, 5)) * size).astype(np.int64)
    values[::7] = values[0]
    for level in (1, 4, 1 << 20):
        index = topk.ImpactIndex(values, level)
        for row in range(0, 500, 60):
            query = values[row] // max(1, size // 1000)
            members = index.possible(query, 5, np.array([row]))
            scores = values @ query
            scores[row] = np.iinfo(np.int64).min
            kth = np.sort(scores)[-5]
            assert set(np.flatnonzero(scores >= kth).tolist()) <= set(members.tolist())


def test_op2_query(spark):
    found = queries.op2_exact_top_k(spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, found)) == sorted(oracle("op2_exact_top_k", embeddings=f"{SF}/embeddings.parquet"))


def test_op2_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [0.0, 0.0]), (8, [1.0]),
            (50, [-1.0, 0.001]), (50, [-1.0, 0.001]), (100, [2.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, score string")
    ints = topk.quantised(df)
    found = topk.top_k(ints, ints.where("id % 50 = 0"), 3).select("query_id", "rank", "vec_id", "score").collect()
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    assert sorted(map(tuple, found)) == plain_top(kept, dict(r for r in kept if r[0] % 50 == 0).items(), 3)
    assert topk.top_k(ints.where("false"), ints.where("false"), 3).count() == 0


def test_op7_query(spark):
    found = queries.op7_lm_score(spark, SF).select("doc_id", "n_words", "mean_log_score").collect()
    want = {r[0]: r[1:] for r in oracle("op7_lm_score", documents=f"{SF}/documents.parquet")}
    assert len(found) == len(want)
    for r in found:
        assert r.n_words == want[r.doc_id][0] and r.mean_log_score == pytest.approx(want[r.doc_id][1], abs=2e-4)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_op7_orders(spark, order):
    """Every row is scored by all others; an n-gram that they have once counts."""
    docs = [(1, "a b a b a c"), (2, "A  b\tc c"), (3, ""), (4, None), (5, "z"), (6, "a b c d"), (6, "d"), (7, "q c c d q"), (None, "a b"), (None, "a b"), (8, "long q " * 30_000)]
    found = {r.doc_id: r for r in lm_score.scores(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, score string"), order=order).collect()}
    rows = [(i, (t or "").lower().split()) for i, t in docs]

    def grams(w):
        counts = {}
        for n in range(1, order + 1):
            for i in range(len(w) - n + 1):
                counts[tuple(w[i : i + n])] = counts.get(tuple(w[i : i + n]), 0) + 1
        return counts

    own, everywhere = [grams(w) for _, w in rows], {}
    for counts in own:
        for g, c in counts.items():
            everywhere[g] = everywhere.get(g, 0) + c
    total = sum(len(w) for _, w in rows)
    want = {}
    for (id_, w), mine in zip(rows, own):
        other = lambda g: everywhere[g] - mine[g]  # noqa: E731, B023
        s = want.setdefault(id_, [0, 0.0])
        for i in range(len(w)):
            s[0] += 1
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i + 1 - n : i + 1])
                if n == 1:
                    s[1] += math.log(max(other(gram), 1) / (total - len(w)))
                elif other(gram):
                    s[1] += math.log(other(gram) / other(gram[:-1]))
                    break
                else:
                    s[1] += math.log(lm_score.BACKOFF)
    assert set(found) == set(want)
    for id_, (n, s) in want.items():
        assert found[id_].n_words == n and (found[id_].score == pytest.approx(s) if n else found[id_].score is None)
    assert lm_score.scores(no_documents(spark)).count() == 0


def test_op7_chunks(spark):
    """N-grams that meet over chunks, buckets and passes count as they do within one chunk."""
    rnd = random.Random(7)
    vocabulary = ["a", "b", "Über", "x" * 200_000, *(f"w{i}" for i in range(40))]
    weights = [300, 300, 30, 0.1, *[3] * 40]
    docs = [(i % 390 or None, " \t".join(rnd.choices(vocabulary, weights, k=rnd.choice([0, 1, 2, 40])))) for i in range(400)] + [(7, None), (8, "a b " * 3_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    one = {r.doc_id: r for r in lm_score.scores(df.coalesce(1), chunk_bytes=1 << 30).collect()}
    many = {r.doc_id: r for r in lm_score.scores(df, chunk_bytes=100, passes=3).collect()}
    assert set(one) == set(many) == {i for i, _ in docs}
    for id_, r in one.items():
        assert many[id_].n_words == r.n_words and many[id_].score == (pytest.approx(r.score) if r.n_words else None)


def test_op7_disk(spark, tmp_path):
    """What the scores leave on disk, shuffle files and tables, stays under four times their input."""
    rnd = random.Random(11)
    vocabulary = ["".join(rnd.choices("abcdefghijklmnop", k=3)) for _ in range(30_000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=300))) for i in range(3_000)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.option("compression", "zstd").parquet(f"{tmp_path}/in")

    def files(*tops):
        return {f"{d}/{x}": os.path.getsize(f"{d}/{x}") for top in tops for d, _, names in os.walk(top) for x in names if os.path.exists(f"{d}/{x}")}

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    tops = [*blocks.localDirsString(), checkpoint_dir(spark).removeprefix("file:")]
    before = files(*tops)
    found = lm_score.scores(spark.read.parquet(f"{tmp_path}/in"))
    assert found.agg(F.count("score"), F.sum("n_words")).first() == (3_000, 900_000)
    left = sum(n for f, n in files(*tops).items() if f not in before)
    assert 0 < left < 4 * sum(files(f"{tmp_path}/in").values())


def test_op9_query(spark):
    found = queries.op9_warc_revisits(spark, SF01)
    cols = ["record_id", "status", "refers_to", "n_bytes", "body_md5", "headers"]
    rows = sorted(map(tuple, found.select(*cols).collect()))
    assert rows == sorted(oracle("op9_warc_revisits", pages=f"{SF01}/pages.parquet"))
    assert {r[1] for r in rows} == {"orphan", "mismatch", "resolved"}


def test_op9_rows(spark, monkeypatch):
    monkeypatch.setattr(warc, "SLICE", 10)
    full = lambda i, url, ts, body="b", **h: (i, url, ts, "response", {k.replace("_", "-"): v for k, v in h.items()}, body, "x")
    again = lambda i, url, ts, **h: (i, url, ts, "revisit", {k.replace("_", "-"): v for k, v in h.items()}, None, "x")
    records = [
        full(1, "http://www.Example.com:80/a/?b=2&a=1&utm_source=x#f", 5, "one", ETag='"1"', Content_Type="text/html", Date="d1"),
        full(2, "https://example.com/a?a=1&b=2", 48, "two", ETag='"2"'),
        full(3, "https://example.com/a?a=1&b=2", 48, "three", ETag='"3"'),
        again(11, "example.com/a?b=2&a=1", 47, etag='W/"1"', date="d2", content_type="gone", connection="close"),
        again(12, "example.com/a?b=2&a=1", 48, etag='"3"'),  # same time as 2 and 3: not later
        again(13, "example.com/a?b=2&a=1", 49, etag='"3"'),
        again(14, "example.com/a?b=2&a=1", 10**9, etag='"2"'),
        again(15, "example.com/a?b=2&a=1", 3, etag='"1"'),
        again(16, "example.com/a?b=2&a=1", 50, last_modified="m"),
        again(17, None, 50),
        again(18, "example.com/a?b=2&a=1", None),
        again(19, "example.com/A?b=2&a=1", 50),
        full(4, "x.org", 1, None, last_modified="m"),
        again(20, "x.org/", 60, Last_Modified="m"),
        (21, "x.org", 70, "revisit", None, None, "x"),
        (None, "x.org", 2, "response", None, "?", "x"),
        (22, "x.org", 70, None, None, None, "x"),
    ]
    schema = "record_id long, url string, ts long, kind string, headers map<string,string>, body string, status string"
    df = spark.createDataFrame(records, schema)
    found = {r.record_id: r for r in warc.resolve_revisits(df).collect()}
    status = {i: (r.status, r.refers_to, r.body) for i, r in found.items()}
    assert status == {
        11: ("resolved", 1, "one"), 12: ("mismatch", 1, None), 13: ("resolved", 3, "three"), 14: ("mismatch", 3, None), 15: ("orphan", None, None),
        16: ("unvalidated", 3, None), 17: ("orphan", None, None), 18: ("orphan", None, None), 19: ("orphan", None, None), 20: ("resolved", 4, None), 21: ("unvalidated", 4, None),
    }
    assert found[11].headers == {"etag": 'W/"1"', "content-type": "text/html", "date": "d2"}
    assert found[16].headers == {"last-modified": "m"} and found[21].headers == {}
    assert warc.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_canonical_url(spark):
    urls = ["HTTP://M.Site.org:443/p/q//?z=1&&a=2&ref=3#x", "site.org/p/q?a=2&z=1", "https://site.org", "site.org/", None, "", "//x"]
    rows = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").select(warc.canonical_url(F.col("u"))).collect()]
    assert rows[0] == rows[1] == "site.org/p/q?a=2&z=1" and rows[2] == rows[3] == "site.org" and rows[4] is None


def plain_pipeline(docs):
    """The stages on a list of rows, without Spark."""
    docs = [d for d in docs if d["text"] is not None and langid.has_letter(d["text"])]
    docs.sort(key=lambda d: d["doc_id"])
    prints, kept = [simhash.fingerprint_of(d["text"], 3) & (2**64 - 1) for d in docs], list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3 and kept[i] != kept[j]:
                low, high = sorted((kept[i], kept[j]))
                kept = [low if k == high else k for k in kept]
    docs = [d for i, d in enumerate(docs) if kept[i] == i]
    out = {}
    for d, (raw, covered) in zip(docs, plain_removed([d["text"] for d in docs])):
        out[d["doc_id"]] = bytes(b for b, c in zip(raw, covered) if not c).decode("utf-8", "ignore")
    return out


def test_pipeline_query(spark):
    docs = [r.asDict() for r in queries.table(spark, SF, "documents").collect()]
    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    check_packing(rows, plain_pipeline(docs), queries.SEQUENCE_TOKENS)


def test_near_dedup_of_repeated_ids(spark):
    """Rows that share an id stay by group: another text of the id stays, near copies and equal rows go."""
    a, b = " ".join(f"apple{i}" for i in range(300)), " ".join(f"stone{i}" for i in range(300))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 2), (1, b, "en", "s", 2), (2, a, "en", "s", 3), (3, b, "en", "t", 4), (1, a, "en", "s", 9), (None, a, "en", "s", 5)]
    kept = []
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, frames.DOCUMENTS).withColumn("row_hash", F.lit("x"))
        kept.append(sorted(((r.doc_id or 0), r.text[:5], r.n_chars) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()))
    assert kept[0] == kept[1] and [k[:2] for k in kept[0]] == [(0, "apple"), (1, "apple"), (1, "stone")]


def test_pipeline_stages(spark):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.columns == docs.columns and dict(kept.dtypes) == dict(docs.dtypes), name
        docs = spark.createDataFrame(kept.collect(), docs.schema)
        assert all(r.spans == "x" and r.score == "x" for r in docs.collect())
        empty = stage(spark, no_documents(spark), SF)
        assert empty.count() == 0 and empty.columns == no_documents(spark).columns
    assert sorted(r.doc_id or 0 for r in docs.collect()) == [0, 1, 2, 3, 9, 10]
    assert corpus_pipeline.STAGES[-1][1](spark, no_documents(spark), SF).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() >= 6
