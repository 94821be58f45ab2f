"""SimHash, embedding and suffix-array dedup against brute force."""

import hashlib
import os
import re
import sys
import threading
import time

import numpy as np
import pandas as pd
import pytest
import xxhash
from frames import PASSAGE, no_documents, odd_documents
from pyspark import cloudpickle
from pyspark.sql import functions as F

from cohortac.llm import embedding_dedup, queries, simhash, suffix_dedup, suffix_sort
from cohortac.llm.components import Forest, components

SF = "/root/testdata/sf0.001"


def smallest_reachable(n, links):
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def plain_fingerprint(text, words=3):
    found = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + words]).encode(), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_components(spark):
    rng = np.random.default_rng(0)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(500, int(x)) for x in range(501, 700)] + rng.integers(1000, 1400, (300, 2)).tolist() + [(7, 7)]
    found = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    nodes = sorted({x for p in pairs for x in p})
    place = {x: i for i, x in enumerate(nodes)}
    want = smallest_reachable(len(nodes), [(place[a], place[b]) for a, b in pairs])
    assert {x: found.get(x, x) for x in nodes} == {x: nodes[r] for x, r in zip(nodes, want)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest():
    forest = Forest(6)
    forest.link(np.array([5, 4, 1]), np.array([4, 1, 1]))
    assert forest.root.tolist() == [0, 1, 2, 3, 1, 1] and [x.tolist() for x in forest.edges()] == [[4, 5], [1, 1]]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 7])
def test_bit_sliced_comparison(radius):
    rng = np.random.default_rng(radius)
    for _ in range(12):
        n = int(rng.integers(1, 300))
        base = rng.integers(0, 2**63, max(1, n // 20), dtype=np.uint64)
        fps = base[rng.integers(0, len(base), n)].copy()
        for _ in range(5):
            flip = rng.random(n) < 0.6
            fps[flip] ^= np.uint64(1) << rng.integers(0, 64, flip.sum()).astype(np.uint64)
        group = np.sort(rng.integers(0, rng.integers(1, 9), n))
        got = [p for a, b in simhash.close_pairs(fps, group, radius) for p in zip(a.tolist(), b.tolist())]
        want = {(i, j) for i in range(n) for j in range(i + 1, n) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius}
        assert len(got) == len(set(got)) and set(got) == want


def check_simhash(rows, texts, radius=3):
    ids = sorted(texts)
    prints = [plain_fingerprint(texts[i]) for i in ids]
    links = [(i, j) for i in range(len(ids)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    want = smallest_reachable(len(ids), links)
    assert {(r[0], r[1], r[2]) for r in rows} == {(i, f"{p:016x}", ids[w]) for i, p, w in zip(ids, prints, want)}


def test_op1_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op1_simhash_dedup(spark, SF).select("doc_id", "fingerprint", "component_id").collect()
    assert len(rows) == len(texts)
    check_simhash(rows, texts)


def test_op1_rows(spark):
    docs = odd_documents(spark)
    rows = simhash.near_duplicates(docs).select("doc_id", simhash.as_hex(F.col("fp")), "component_id").collect()
    assert len(rows) == 13 and [r for r in rows if r[0] is None and r[2] is not None] == []
    check_simhash([r for r in rows if r[0] is not None], {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None})
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


def test_hot_bucket_is_dealt_into_chunks(spark):
    rng = np.random.default_rng(5)
    fps = (np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64))).view(np.int64)
    fps = np.unique(fps).tolist()
    classes = spark.createDataFrame([(f, i) for i, f in enumerate(fps)], "fp long, node long")
    for chunk in (1000, 7):
        found = simhash.links(classes, 3, chunk).collect()
        want = smallest_reachable(len(fps), [(i, j) for i in range(len(fps)) for j in range(i) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 3])
        assert smallest_reachable(len(fps), found) == want


def plain_links(rows, threshold):
    """(n_links, component) by comparing all vectors of a label."""
    n, links = [0] * len(rows), []
    for i, (_, a, la) in enumerate(rows):
        for j in range(i):
            b, lb = rows[j][1:]
            if la is None or la != lb or not (fit(a) and fit(b)) or len(a) != len(b):
                continue
            a_, b_ = np.array(a, float), np.array(b, float)
            if a_ @ b_ / np.sqrt(a_ @ a_) / np.sqrt(b_ @ b_) >= threshold:
                links.append((i, j))
                n[i] += 1
                n[j] += 1
    return n, smallest_reachable(len(rows), links)


def fit(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


VECTORS = "vec_id long, embedding array<float>, label int, n_links string, root string"


def test_op3_rows(spark):
    inf, nan = float("inf"), float("nan")
    vectors = [(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
               (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1), (11, [1.0, 0.0], 1), (12, [2.0, 0.0], 1), (13, [1.0, 0.0, 0.0], 1),
               (14, [3e38, 0.0], 1), (15, [-0.0, 1.0], 1), (16, [0.0, 1.0], 1), (17, [-1.0, 0.0], 1)]
    df = spark.createDataFrame([(*v, "x", "y") for v in vectors] + [(None, [1.0, 0.0], 1, "x", "y")], VECTORS)
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, 0.93).collect()}
    n, root = plain_links(vectors, 0.93)
    assert rows.pop(None) == (0, None, True)
    assert rows == {v[0]: (k, vectors[c][0], vectors[c][0] == v[0]) for v, k, c in zip(vectors, n, root)}
    assert embedding_dedup.near_duplicates(df.where("false"), 0.93).count() == 0
    twice = embedding_dedup.near_duplicates(df.where("vec_id = 1").union(df.where("vec_id = 1")), 0.93).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in twice] == [(1, 1, True)] * 2


def clustered(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((n // 12, dims))
    v = centres[rng.integers(0, len(centres), n)] + rng.standard_normal((n, dims)) * rng.uniform(0.05, 0.35, (n, 1))
    return [(i, [float(x) for x in np.float32(row)], int(i % 3)) for i, row in enumerate(v)]


def test_op3_recall_and_counts(spark):
    rows = clustered(1500, 32, 1)
    df = spark.createDataFrame([(*r, "", "") for r in rows], VECTORS)
    n, root = plain_links(rows, 0.93)
    assert sum(n) > 1000
    for leaf in (64, 4096):
        found = {r.vec_id: r for r in embedding_dedup.near_duplicates(df, 0.93, leaf_rows=leaf).collect()}
        assert all(found[i].n_links <= n[i] and found[i].component_id >= root[i] for i in range(len(rows)))
        assert sum(r.n_links for r in found.values()) >= (0.95 if leaf == 64 else 1) * sum(n)


def test_op3_query(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, SF, "embeddings").orderBy("vec_id").collect()]
    n, root = plain_links(rows, queries.COSINE)
    found = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op3_embedding_dedup(spark, SF).collect()}
    assert found == {r[0]: (k, rows[c][0], rows[c][0] == r[0]) for r, k, c in zip(rows, n, root)}


def test_suffix_order(monkeypatch):
    rng = np.random.default_rng(0)
    for _ in range(400):
        monkeypatch.setattr(suffix_sort, "BLOCK", int(rng.choice([1, 3, 8, 64])))
        symbols = int(rng.integers(1, 6))
        text = rng.integers(1, symbols + 1, int(rng.integers(0, rng.choice([4, 12, 60, 200]))))
        if rng.random() < 0.4 and len(text) > 4:
            text = np.tile(text[: max(1, len(text) // rng.integers(2, 6))], 6)[: len(text)]
        if rng.random() < 0.3:
            text = np.repeat(text, rng.integers(1, 6, len(text)))
        text = np.append(text, 0)
        order, common = suffix_sort.suffix_order(text, symbols + 1, memory=int(rng.choice([100, 1 << 26])), direct=int(rng.choice([0, 20, 10**6])))
        t = text.tolist()
        want = sorted(range(len(t)), key=lambda i: t[i:])
        prefixes = [0]
        for a, b in zip(want, want[1:]):
            k = 0
            while t[a + k] == t[b + k]:
                k += 1
            prefixes.append(k)
        assert order.tolist() == want and common.tolist() == prefixes


def test_queue_goes_to_disk():
    queue = suffix_sort.Queue(3, memory=100)
    for k in range(50):
        queue.put(np.array([2, 0, 1, 0]), np.arange(12).reshape(3, 4) + k)
    assert queue.spills > 5
    assert queue.take(0).tolist() == [[x for k in range(50) for x in (1 + k + r, 3 + k + r)] for r in (0, 4, 8)]
    queue.close()


def test_segments_hold_every_window_once():
    rng = np.random.default_rng(3)
    for trial in range(120):
        length, gram = [(100, 32), (12, 4), (7, 4), (9, 8)][trial % 4]
        docs = []
        for _ in range(rng.integers(1, 8)):
            d = bytes(rng.integers(97, 97 + rng.integers(1, 5), int(rng.integers(0, 60 if length < 100 else 700))).astype(np.uint8))
            if docs and rng.random() < 0.7:
                d = d[: len(d) // 2] + docs[0][: rng.integers(0, 300)] + d[len(d) // 2 :]
            docs.append(d)
        raw, ends = b"".join(docs), np.cumsum([len(d) for d in docs])
        own = {}
        for start, n, h in zip(*(x.tolist() for x in suffix_dedup.segments(np.frombuffer(raw, np.uint8), ends, length, gram))):
            for p in range(start, start + n):
                assert p not in own
                own[p] = h
        assert sorted(own) == [p for e, d in zip(ends.tolist(), docs) for p in range(e - len(d), e - length + 1)]
        by_window = {}
        assert all(by_window.setdefault(raw[p : p + length], h) == h for p, h in own.items())


def plain_removed(texts, length=100):
    """Covered bytes of texts given in order of id."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        covered = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            w = raw[p : p + length]
            if w in seen:
                covered[p : p + length] = b"\1" * length
            seen.add(w)
        out.append((raw, covered))
    return out


def check_spans(rows, docs):
    for (id_, raw, covered), r in zip(((i, *x) for (i, _), x in zip(docs, plain_removed([t for _, t in docs]))), rows):
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        runs = sum(1 for k, c in enumerate(covered) if c and (k == 0 or not covered[k - 1]))
        assert (r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (id_, len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest())


def test_op8_query(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF, "documents").orderBy("doc_id").collect()]
    check_spans(queries.op8_suffix_array_dedup(spark, SF).orderBy("doc_id").collect(), docs)


def test_op8_rows(spark, tmp_path):
    docs = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    periodic = spark.createDataFrame([(20, "abcabd" * 200), (21, "z" * 500), (22, PASSAGE + "é" * 120), (23, "é" * 130)], "doc_id long, text string")
    docs.select("doc_id", "text").union(periodic).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op8_suffix_array_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()
    check_spans(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{tmp_path}/documents.parquet").orderBy("doc_id").collect()])
    # Repeated rows are one document; a null id is the earliest.
    found = suffix_dedup.repeated_spans(odd_documents(spark), spans="where").collect()
    assert len(found) == 13 and found[0].asDict()["spans"] == "x"
    both = [r for r in found if r.doc_id == 10]
    assert both[0]["where"] == both[1]["where"]
    assert all(not r["where"] for r in found if r.doc_id is None)
    assert [r["where"] for r in found if r.doc_id == 1] != [[]]
    assert suffix_dedup.repeated_spans(no_documents(spark)).count() == 0


def test_remaining_text_drops_cut_characters(spark):
    df = spark.createDataFrame([("aéb", [(2, 3)]), (None, []), ("abc", [])], "t string, s array<struct<start:long,stop:long>>")
    rows = [r[0] for r in df.select(suffix_dedup.remaining_text(F.col("t"), F.col("s"))).collect()]
    assert rows == ["ab", "", "abc"]


def test_whole_groups():
    frames = [pd.DataFrame({"k": k, "v": range(len(k))}) for k in ([1, 1, 2], [2], [], [2, 3, 4], [4], [5])]
    parts = [p["k"].tolist() for p in simhash.whole_groups(iter(frames), ["k"])]
    assert [k for p in parts for k in p] == [1, 1, 2, 2, 2, 3, 4, 4, 5]
    assert sum(len(set(p)) for p in parts) == 5


def test_op3_dense_group_is_compared_whole(spark):
    """A third of the rows are near copies of one vector (typical cosine 0.94)."""
    rng, n, dims = np.random.default_rng(4), 6000, 64

    def directions(k):
        v = rng.standard_normal((k, dims))
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    v = directions(n)
    v[: n // 3] = np.sqrt(0.94) * directions(1) + np.sqrt(0.06) * v[: n // 3]
    v = np.float32(v)
    df = spark.createDataFrame([(i, [float(x) for x in row], 1, "", "") for i, row in enumerate(v)], VECTORS)
    wide = embedding_dedup.unit(v)
    near = wide @ wide.T >= 0.93
    want = near.sum(axis=1) - 1
    for chunk in (embedding_dedup.CHUNK, 500):
        found = np.zeros(n, np.int64)
        for r in embedding_dedup.near_duplicates(df, 0.93, leaf_rows=64, chunk=chunk).collect():
            found[r.vec_id] = r.n_links
        assert (found <= want).all() and found.sum() >= 0.99 * want.sum()


def test_hot_anchor_is_spread(spark, monkeypatch):
    """One string among ever different bytes, some of them equal far enough to make a repeat."""
    rng = np.random.default_rng(6)
    data = bytes(rng.integers(97, 123, 200).astype(np.uint8))
    h = suffix_dedup.gram_hashes(np.frombuffer(data, np.uint8))
    middle = data[int(h.argmin()) : int(h.argmin()) + suffix_dedup.GRAM].decode()  # mostly its windows' anchor

    def letters(k):
        return "".join(map(chr, rng.integers(97, 123, k)))

    sides = [(letters(80), letters(80)) for _ in range(12)]
    near = [("".join(a)[-k:], "".join(b)[:m]) for a, b in sides for k, m in ((80, 80), (40, 60), (5, 70), (60, 20), (17, 51), (34, 34))]
    texts = [letters(90) + a + middle + b + letters(90) for a, b in near * 2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = [covered for _, covered in plain_removed(texts)]
    assert sum(map(any, want)) > 20
    largest = {}
    for hot in (10**9, 3):
        source = open(suffix_dedup.__file__).read().replace("HOT = 10_000", f"HOT = {hot}")
        module = type(suffix_dedup)("spread_dedup")
        monkeypatch.setitem(sys.modules, "spread_dedup", module)
        exec(source, module.__dict__)
        cloudpickle.register_pickle_by_value(module)
        dealt = []
        monkeypatch.setattr(module, "_spread", lambda *a, f=module._spread: dealt.append(f(*a)) or dealt[0])
        rows = module.repeated_spans(docs).orderBy("doc_id").collect()
        for r, covered in zip(rows, want):
            got = bytearray(len(covered))
            for s in r.spans:
                got[s["start"] : s["stop"]] = b"\1" * (s["stop"] - s["start"])
            assert got == covered
        largest[hot] = [max(x.where("part is not null").groupBy("h").agg(F.countDistinct("part").alias("n")).agg(F.max("n")).first()) for x in dealt]
    assert largest[10**9] == [] and largest[3][0] <= 3


def test_components_of_large_labels(spark):
    """Labels are any 64-bit numbers (fingerprints): nothing overflows."""
    far = 2**62
    chain = [(far + k, far + k + 1) for k in range(40)] + [(-far - k, -far - k - 1) for k in range(40)] + [(2**63 - 1, -(2**63))]
    edges = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    want = {far + k: far for k in range(1, 41)} | {-far - k: -far - 40 for k in range(40)} | {2**63 - 1: -(2**63)}
    assert got == want


def test_components_with_hubs_far_past_the_rest(spark, monkeypatch):
    """Nodes with most of the edges take the broadcast way, all others the shuffled one."""
    module = sys.modules[components.__module__]
    monkeypatch.setattr(module, "FEW", 5)
    pairs = [(3, 10_000 + k) for k in range(900)] + [(40_000 + k, 9) for k in range(700)] + [(10_450, 40_001)] + [(20_000 + k, 20_001 + k) for k in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs * 2, "a long, b long")).collect()}
    nodes = sorted({x for p in pairs for x in p})
    place = {x: i for i, x in enumerate(nodes)}
    want = smallest_reachable(len(nodes), [(place[a], place[b]) for a, b in pairs])
    assert {x: got.get(x, x) for x in nodes} == {x: nodes[r] for x, r in zip(nodes, want)}


def test_op3_leaves_past_the_sample_are_split_on(spark, monkeypatch):
    """A sample far too small for the rows: leaves are split by trees of their own; links stay right."""
    module, split = embedding_dedup, []
    monkeypatch.setattr(module, "SAMPLE", 150)
    monkeypatch.setattr(module, "LARGE", 2)
    monkeypatch.setattr(module, "ROUTE_ROWS", 100)
    plain = module.split_large
    monkeypatch.setattr(module, "split_large", lambda routed, *a: split.append((routed, plain(routed, *a))) or split[0][1])
    rows = clustered(2400, 32, 3)
    n, root = plain_links(rows, 0.93)
    found = {r.vec_id: r for r in module.near_duplicates(spark.createDataFrame([(*r, "", "") for r in rows], VECTORS), 0.93, leaf_rows=50).collect()}
    assert all(found[i].n_links <= n[i] and found[i].component_id >= root[i] for i in range(len(rows)))
    assert sum(r.n_links for r in found.values()) >= 0.9 * sum(n)
    largest = [x.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().agg(F.max("count")).first()[0] for x in split[0]]
    assert largest[0] > 100 >= (largest[1] or 0)


def test_op3_tree_sizes_at_any_number_of_rows():
    """Leaves of the first trees at 10 ** 8 rows, and of the trees that split those on."""
    rng = np.random.default_rng(5)
    n, dims = 10**8, 64
    sample = embedding_dedup.unit(rng.standard_normal((embedding_dedup.SAMPLE, dims)))
    margin, leaf = embedding_dedup.spread(0.93, dims), max(16, embedding_dedup.LEAF_ROWS * embedding_dedup.SAMPLE // n)
    first = embedding_dedup.Tree()
    first.grow(sample, leaf, margin, np.random.default_rng(0))
    rows_a_leaf = np.bincount(first.route(sample)[1]).max() * n // len(sample)
    assert rows_a_leaf > embedding_dedup.LARGE * embedding_dedup.LEAF_ROWS and not first.dense
    inside = min(embedding_dedup.SAMPLE, embedding_dedup.LEAF_SAMPLE * rows_a_leaf // embedding_dedup.LEAF_ROWS)
    second = embedding_dedup.Tree()
    second.grow(embedding_dedup.unit(rng.standard_normal((inside, dims))), max(16, embedding_dedup.LEAF_ROWS * inside // rows_a_leaf), margin, rng)
    fresh = embedding_dedup.unit(rng.standard_normal((200_000, dims)))
    assert np.bincount(second.route(fresh)[1]).max() * rows_a_leaf / len(fresh) <= embedding_dedup.LARGE * embedding_dedup.LEAF_ROWS


def test_flagged_runs():
    rng = np.random.default_rng(8)
    for _ in range(50):
        flags = [rng.random(int(k)) < 0.5 for k in rng.integers(1, 9, int(rng.integers(1, 6)))]
        found = list(zip(*(x.tolist() for x in suffix_dedup._flagged_runs(flags))))
        want = []
        for row, own in enumerate(flags):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], own, [0]))))
            want += [(row, a, b) for a, b in edges.reshape(-1, 2).tolist()]
        assert found == want


def test_segments_are_runs_of_windows_with_one_anchor():
    """Every window of a document has the leftmost of its least-hashed strings as anchor; ties in one-letter and periodic texts."""
    rng = np.random.default_rng(11)
    for _ in range(400):
        sizes = rng.integers(0, 40, int(rng.integers(1, 6)))
        data = rng.integers(97, 97 + int(rng.choice([1, 2, 3, 20])), sizes.sum()).astype(np.uint8)
        if rng.random() < 0.4 and len(data):
            data = np.resize(data[: int(rng.integers(1, 9))], len(data))
        ends, gram = np.cumsum(sizes), int(rng.choice([1, 2, 4, 8]))
        length = gram + int(rng.integers(0, 12))
        wanted, begin = [], 0
        for end in ends.tolist():
            last = None
            for w in range(begin, end - length + 1):
                least = suffix_dedup.gram_hashes(data[w : w + length], gram, np.uint32)
                at = w + int(np.argmin(least))
                if at == last:
                    wanted[-1][1] += 1
                else:
                    wanted.append([w, 1, int(suffix_dedup.gram_hashes(data[at : at + gram], gram).view(np.int64)[0])])
                last = at
            begin = end
        assert np.stack(suffix_dedup.segments(data, ends, length, gram), axis=1).tolist() == wanted


def test_sorting_a_shard_stays_in_bounded_memory():
    """Each Python worker of an executor sorts a shard at a time; six of them have to fit beside the JVM."""
    import tracemalloc

    pick = np.random.default_rng(3)
    words = [bytes(pick.integers(97, 123, n, np.uint8)) for n in pick.integers(2, 10, 5000)]
    parts = [b" ".join(words[i] for i in pick.integers(0, len(words), 26))[:170].ljust(170, b"x") for _ in range(suffix_dedup.SHARD_BYTES // 170)]
    rank = np.stack([np.arange(len(parts)), np.zeros(len(parts), int), np.zeros(len(parts), int)], 1)
    tracemalloc.start()
    try:
        suffix_dedup.repeated_windows(parts, rank)
        assert tracemalloc.get_traced_memory()[1] < 120_000_000
    finally:
        tracemalloc.stop()


def test_parts_without_a_common_window():
    """Parts that share an anchor and no whole window: nothing repeats."""
    anchor = b"0123456789abcdefghijklmnopqrstuv"
    parts = [x * 60 + anchor + y * 60 for x, y in ((b"a", b"b"), (b"c", b"d"))]
    flags = suffix_dedup.repeated_windows(parts, np.array([[1, 0, 0], [2, 0, 0]]))
    assert [len(f) for f in flags] == [len(p) - suffix_dedup.LENGTH + 1 for p in parts] and not np.concatenate(flags).any()


def most_on_disk(spark, run):
    """Bytes of new shuffle files that the session held at most while ``run`` ran."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    # The manager makes its folders before any file.
    folders, seen, done = [d.getPath() for d in manager.localDirs()], [], threading.Event()

    def held():
        paths = (os.path.join(at, f) for d in folders for at, _, names in os.walk(d) for f in names if f.startswith("shuffle_"))
        return {p: os.path.getsize(p) for p in paths if os.path.exists(p)}

    def watch():
        while not done.is_set():
            try:
                seen.append(sum(size for p, size in held().items() if p not in before))
            except FileNotFoundError:  # removed meanwhile
                pass
            time.sleep(0.02)

    before = held()
    thread = threading.Thread(target=watch)
    thread.start()
    try:
        run()
    finally:
        done.set()
        thread.join()
    return max(seen)


def test_op3_moves_vectors_a_few_times(spark):
    """Shuffle files of the run stay a small multiple of the vectors, which many leaves of many trees hold."""
    n, dims = 3000, 64
    v = np.float32(np.random.default_rng(6).standard_normal((n, dims)))
    df = spark.createDataFrame([(i, [float(x) for x in row], 1, "", "") for i, row in enumerate(v)], VECTORS).localCheckpoint()
    assert most_on_disk(spark, lambda: embedding_dedup.near_duplicates(df, 0.93, leaf_rows=64).collect()) < 4 * v.nbytes


def test_op3_rounds_and_labels_of_any_size(spark, monkeypatch):
    """Links do not depend on the number of rounds; a table may have labels that are compared whole beside larger ones."""
    module, rounds = embedding_dedup, []
    rows = [(i, v, min(k, 1)) for i, v, k in clustered(1500, 32, 7)]
    df = spark.createDataFrame([(*r, "", "") for r in rows], VECTORS)
    n, root = plain_links(rows, 0.93)
    plain, found = module.rounds_of, []
    monkeypatch.setattr(module, "rounds_of", lambda *a: rounds.append(plain(*a)) or rounds[-1])
    for least in (15_000, 1 << 20):
        monkeypatch.setattr(module, "ROUND_ROWS", least)
        found.append({r.vec_id: (r.n_links, r.component_id) for r in module.near_duplicates(df, 0.93, leaf_rows=64, whole=600).collect()})
    assert rounds[1] > 1 and rounds[3] == 1 and found[0] == found[1]
    assert all(found[0][i] == (n[i], root[i]) for i, _, k in rows if k == 0)
    assert all(found[0][i][0] <= n[i] for i in range(len(rows))) and sum(x for x, _ in found[0].values()) >= 0.95 * sum(n)


def test_op3_classes_with_one_key(spark, monkeypatch):
    """Should two classes have the same key, rows find theirs by label and vector."""
    monkeypatch.setattr(embedding_dedup, "class_key", lambda: F.lit(7).cast("long"))
    test_op3_rows(spark)
