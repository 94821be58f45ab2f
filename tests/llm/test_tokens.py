"""Token counts, byte-level BPE and packing against the libraries and brute force."""

import hashlib
import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from frames import no_documents, odd_documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortac.llm import byte_bpe, packing, queries, token_counts

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")


def random_texts(n, seed=1):
    pick = random.Random(seed)
    odd = [" " * 500, "a" * 700, "ab" * 900, "=-" * 400, "", "<|endoftext|>", "\n\n  a", "x<|endoftext|><|startoftext|>y"]
    return odd + ["".join(pick.choice("aAéÉ 1½\n\x1c'sretlmd<|>µ́漢İßΣ \xa0!?\t") for _ in range(60)) for _ in range(n)]


def tiktoken_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={})


def test_word_counts_are_the_librarys():
    texts, counter = random_texts(1500), token_counts.WordCounter(WORD_JSON)
    wanted = Tokenizer.from_file(WORD_JSON).encode_batch_fast(texts, add_special_tokens=False)
    assert [counter.count(t) for t in texts] == [len(e.ids) for e in wanted]


def test_merges_by_heap_and_list():
    ranks = {("a", "b"): (0, "ab"), ("ab", "ab"): (1, "abab"), ("b", "a"): (2, "ba")}
    pair = lambda a, b: ranks.get((a, b))
    assert token_counts.merges_of(5, pair, list("ababa")) == 3
    assert token_counts.merges_of(3, pair, list("bab")) == 1
    assert token_counts.merges_of(1, pair, ["a"]) == 0


def test_op4_rows(spark):
    docs = odd_documents(spark)
    rows = token_counts.count_tokens(docs, WORD_JSON).select("text", "n_bytes", "n_tokens", "over_limit", "spans").collect()
    t = Tokenizer.from_file(WORD_JSON)
    assert len(rows) == 13
    for r in rows:
        n = len(t.encode(r.text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit, r.spans) == (len((r.text or "").encode()), n, n > 2048, "x")
    assert token_counts.count_tokens(no_documents(spark), WORD_JSON).count() == 0


def test_op4_query(spark):
    t = Tokenizer.from_file(WORD_JSON)
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op4_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in rows} == {k: len(t.encode(v, add_special_tokens=False).ids) for k, v in texts.items()}


def test_prefix_encoding_is_the_librarys():
    texts, own = random_texts(1500, 2), byte_bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken_encoding()
    for text, ids in zip(texts, own.encode(texts)):
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()


def test_prefix_table_appends_and_edits():
    encoder, pick = byte_bpe.PrefixEncoder(byte_bpe.read_ranks(RANKS)), random.Random(3)
    anew = 0
    for _ in range(60):
        piece = bytes(pick.choice(b"abcder ing") for _ in range(400))
        table, at = byte_bpe.PrefixTable(encoder, piece), pick.randrange(390)
        put = bytes(pick.choice(b"abin") for _ in range(pick.randrange(5)))
        anew += table.replace(at, 3, put)
        table.append(b"ing")
        whole = piece[:at] + put + piece[at + 3 :] + b"ing"
        assert table.piece == whole and table.ids() == [encoder.ranks[x] for x in encoder.merged(whole)]
    assert anew < 60 * 300  # entries past an edit are kept


def test_memo_is_bounded(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO_PIECES", 50)
    texts, own = random_texts(200, 4), byte_bpe.TextEncoder(RANKS, public_tokenizers.PATTERN)
    library = tiktoken_encoding()
    assert [list(memoryview(x).cast("I")) for x in own.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_op10_rows(spark):
    encoded = byte_bpe.encode(odd_documents(spark), RANKS, public_tokenizers.PATTERN)
    library = tiktoken_encoding()
    trip = byte_bpe.round_trip(odd_documents(spark).withColumn("found", F.lit("x")), RANKS, public_tokenizers.PATTERN)
    for r in byte_bpe.decode(encoded, RANKS).collect() + trip.collect():
        ids = library.encode_ordinary(r.text or "")
        assert list(memoryview(bytes(r.ids)).cast("I")) == ids and r.n_tokens == len(ids) and bytes(r.decoded) == (r.text or "").encode()
    assert byte_bpe.encode(no_documents(spark), RANKS, public_tokenizers.PATTERN).count() == 0


def test_op10_query(spark):
    library = tiktoken_encoding()
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    rows = queries.op10_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def best_fit(items, capacity):
    rooms = []
    for length in sorted(items, reverse=True):
        fitting = [r for r in rooms if r >= length]
        if fitting:
            rooms[rooms.index(min(fitting))] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("capacity", [1, 5, 20, 64, 1024])
def test_plan_is_best_fit_decreasing(capacity):
    pick = random.Random(capacity)
    for _ in range(150):
        items = [pick.randint(1, pick.choice([capacity, max(1, capacity // 3)])) for _ in range(pick.randint(0, 120))]
        histogram = {n: items.count(n) for n in items}
        plan = packing.plan_bins(histogram, capacity)
        lengths = np.array([n for n in histogram for _ in range(histogram[n])], np.int64)
        ranks = np.array([r for n in histogram for r in range(histogram[n])], np.int64)
        if not len(lengths):
            assert plan.bins == 0
            continue
        bins, offsets = plan.place(lengths, ranks)
        rooms = []
        for b in range(plan.bins):
            end = 0
            for offset, length in sorted((int(offsets[i]), int(lengths[i])) for i in np.flatnonzero(bins == b)):
                assert offset == end
                end += length
            assert 0 < end <= capacity
            rooms.append(capacity - end)
        assert sorted(rooms) == best_fit(items, capacity)


def test_pieces_go_to_the_librarys_model_alone(monkeypatch):
    """A new piece costs the model's work, not a run through the whole tokenizer; ids stay the library's."""
    texts, whole = random_texts(300) + ["日本 é\u3000x<|endoftext|>", "a"] * 2, Tokenizer.from_file(BYTE_JSON)
    wanted = [np.array(whole.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    monkeypatch.setattr(packing, "MEMO_PIECES", 50)  # emptied many times
    library = packing.LibraryIds(BYTE_JSON, public_tokenizers.PATTERN)
    library.tokenizer = SimpleNamespace(model=library.tokenizer.model)
    assert list(library.encode(texts)) == wanted
    library = packing.LibraryIds(BYTE_JSON, public_tokenizers.PATTERN)
    library.by_model = False
    assert list(library.encode(texts)) == wanted


def check_packing(rows, texts, capacity):
    """Every piece of every text once, gapless sequences of best-fit decreasing."""
    t = Tokenizer.from_file(BYTE_JSON)
    ids = {k: [*t.encode(v or "", add_special_tokens=False).ids, queries.END_OF_DOCUMENT] for k, v in texts.items()}
    covered, bins = {}, {}
    for r in rows:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] <= capacity
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r["ids_crc32"]
        covered.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(covered) == set(ids)
    for k, parts in covered.items():
        parts.sort()
        assert [p for p, _, _ in parts] == list(range(len(parts)))
        assert [s for _, s, _ in parts] == [sum(x for _, _, x in parts[:i]) for i in range(len(parts))]
        assert sum(x for _, _, x in parts) == len(ids[k]) and all(x == capacity for _, _, x in parts[1:])
    rooms = []
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        rooms.append(capacity - end)
    assert sorted(rooms) == best_fit([r["length"] for r in rows], capacity)


def test_op6_query(spark):
    texts = {r.doc_id: r.text for r in queries.table(spark, SF, "documents").collect()}
    check_packing([r.asDict() for r in queries.op6_best_fit_packing(spark, SF).collect()], texts, queries.SEQUENCE_TOKENS)


def test_op6_rows(spark):
    docs = odd_documents(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = packing.token_pieces(docs, BYTE_JSON, public_tokenizers.PATTERN, 64, 2).withColumn("ids_crc32", F.crc32("ids"))
    packed = packing.pack(pieces, 64, ["doc_id", "piece"])
    assert "spans" in packed.columns
    check_packing([r.asDict() for r in packed.collect()], texts, 64)
    repeated = packing.pack(packing.token_pieces(odd_documents(spark), BYTE_JSON, public_tokenizers.PATTERN, 64, 2), 64, ["doc_id", "piece"]).collect()
    assert len({(r.sequence_id, r.offset) for r in repeated}) == len(repeated)
    empty = packing.pack(packing.token_pieces(no_documents(spark), BYTE_JSON, public_tokenizers.PATTERN, 64, 2), 64, ["doc_id", "piece"])
    assert empty.count() == 0


def test_ranks_of_a_hot_length_are_dealt_over_many_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_ROWS", 100)
    pieces = spark.range(6000).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 > 0 THEN 10 ELSE id % 7 + 1 END AS length")
    rows = packing.assign(pieces, 10, ["doc_id", "piece"]).collect()
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    rooms = []
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        rooms.append(10 - sum(n for _, n in parts))
    assert len(rows) == 6000 and sorted(rooms) == best_fit([r.length for r in rows], 10)
