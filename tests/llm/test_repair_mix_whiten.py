"""Conversation repair, mixing sources and embedding whitening against plain versions."""

import hashlib
import itertools
import math
import random
import re
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from frames import no_documents, odd_documents
from pyspark.sql import functions as F

from cohortac.llm import conversations, mixing, queries, whitening

SF = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
WHITE = " \t\n\x0b\x0c\r"
CONVERSATIONS = "conv_id long, turn long, role string, text string"


# ---------------------------------------------------------------- conversations
def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def apply_edits(audit, rows):
    """Repaired rows, or None if the edits do not read all rows or the roles are not in order."""
    out, i, extra = [], 0, 0
    for edit in audit:
        due = "assistant" if out and out[-1][0][:1] == "u" else "user"
        if edit == "I":
            out.append((due, ""))
            continue
        if i == len(rows):
            return None
        role, text, doomed, cut = rows[i]
        i += 1
        if edit != "D":
            if doomed:
                return None
            extra += cut
            out.append((role if edit == "K" else due, text))
    if i < len(rows) or not re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in out)):
        return None
    return sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + extra, out


def plain_faults(rows):
    seen, found = set(), []
    for _, role, text in rows:
        bare = text.strip(WHITE)
        found.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return found


def plain_repair(rows):
    """Best (cost, audit) by a table over rows and the last role, strings kept whole."""
    best = {"": (0, "")}

    def inserted(at):
        for _ in range(4):
            for state, (cost, audit) in list(at.items()):
                due = "a" if state == "u" else "u"
                if (cost + 2, audit + "I") < at.get(due, (math.inf, "")):
                    at[due] = (cost + 2, audit + "I")
        return at

    for role, text, doomed, cut in rows:
        nxt = {}
        for state, (cost, audit) in inserted(best).items():
            due = "a" if state == "u" else "u"
            options = [(state, 3, "D")]
            if not doomed:
                options.append((due, 2 + cut, "R"))
                if role[:1] == due or state == "" and role[:1] == "s":
                    options.append((role[:1], cut, "K"))
            for after, c, letter in options:
                if (cost + c, audit + letter) < nxt.get(after, (math.inf, "")):
                    nxt[after] = (cost + c, audit + letter)
        best = nxt
    return min(w for state, w in inserted(best).items() if state in ("", "a"))


def plain_result(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = plain_faults(rows)
    items = [(role, text, f in ("blank", "duplicate"), f == "truncated") for (_, role, text), f in zip(rows, faults)]
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    cost, audit = plain_repair(items)
    found = apply_edits(audit, items)
    assert found[0] == cost
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in found[1]).encode()).hexdigest()
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest


def plain_all(rows):
    by = {conv: [] for conv, *_ in rows}
    for conv, *row in plain_damage(rows):
        by[conv].append(tuple(row))
    return {conv: plain_result(rows) for conv, rows in by.items()}


def results(df):
    assert df.columns == ["conv_id", *conversations.NUMBERS, "audit", "repaired_sha256"]
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def random_rows(seed, n, roles=("user", "assistant", "system", "tool", "")):
    rng = random.Random(seed)
    return [(rng.choice(roles), rng.choice(["a.", "b.", "c", " ", "", "d!"])) for _ in range(n)]


def test_lightest_repair_is_the_least_of_all_edits():
    for seed in range(60):
        rows = random_rows(seed, seed % 5)
        faults = plain_faults([(0, *r) for r in rows])
        items = [(role, text, f in ("blank", "duplicate"), f == "truncated") for (role, text), f in zip(rows, faults)]
        found = []
        for extra in range(3):
            for audit in itertools.product("DIKR", repeat=len(rows) + extra):
                if audit.count("I") == extra and (done := apply_edits(audit, items)):
                    found.append((done[0], "".join(audit)))
        got = conversations.derive([(role[:1], doomed, cut, 0) for role, _, doomed, cut in items], conversations.NOTHING, True)[("goal",)]
        assert got == min(found) == plain_repair(items), (seed, rows)


def test_spans_join_to_the_whole():
    for seed in range(40):
        rows = random_rows(seed, 30, ("user", "assistant", "system", "user", "assistant", "x"))
        items = [(role[:1], text.strip() == "", text == "c", seed % 3 if k % 7 == 0 else 0) for k, (role, text) in enumerate(rows)]
        whole = conversations.derive(items, conversations.NOTHING, True)[("goal",)]
        for chunk in (1, 4, 7, 30):
            parts = [conversations.spans(items[i : i + chunk]) for i in range(0, 30, chunk)]
            assert conversations.join_spans(parts) == whole


def odd_conversations():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant"]), rng.choice(["Yes.", "No!", "Well", "Why?", "　", " \t"])) for c in range(40) for t in rng.sample(range(12), 6)]
    rows += [(100, t, "user" if t % 2 else "assistant", f"Row {t % 50}.") for t in range(300)]  # long, texts come again
    rows += [(101, 1, "user", "Same.")] * 200 + [(101, None, "system", "First.")]  # ties and repeated rows
    rows += [(102, None, None, None), (102, None, "user", None), (103, 5, "system", "x" * 200_000)]
    rows += [(None, None, None, None), (None, 3, "user", "No id."), (None, 4, "assistant", "None.")]
    rows += [(104, t, "", "é.") for t in (1, 1, 2)] + [(105, -3, "system", "S."), (105, 10, "user", "U?"), (105, 11, "assistant", "A.\x0b")]
    return rows


@pytest.mark.parametrize("chunk", [256, 16])
def test_repair_of_odd_conversations(spark, chunk):
    """Short ones whole, long ones in chunks: the same results as the plain version."""
    rows = odd_conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(7)
    for name in ("conv", "audit", "part", "absent", "last", "n", "cost"):
        df = df.withColumn(name, F.lit("x"))
    got = results(conversations.repair(queries.damaged(df), absent=F.col("absent"), chunk=chunk))
    assert got == plain_all(rows)


def test_all_rows_lost_and_empty_table(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "Gone.")], CONVERSATIONS)
    got = results(conversations.repair(queries.damaged(df), absent=F.col("absent")))
    assert got == {lost: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert conversations.repair(df.limit(0)).count() == 0


def test_op11_on_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SF01, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = results(queries.op11_conversation_repair(spark, SF01))
    assert got == plain_all(rows) and sum(r[5] > 0 for r in got.values()) > 20


# ---------------------------------------------------------------- mixing
def plain_targets(sizes, weights=(1, 2, 3), most=3):
    """Shares by weight; what is above a limit is shared again, in fractions."""
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free = {}, set(order)
    while free:
        left = total - sum(target.values())
        share = {s: Fraction(left * w[s], sum(w[x] for x in free)) for s in free}
        above = {s for s in free if share[s] >= most * sizes[s]}
        if not above:
            target |= share
            break
        target |= {s: Fraction(most * sizes[s]) for s in above}
        free -= above
    return target


def check_mix(rows, texts):
    sizes = {}
    for source, text in texts:
        sizes[source] = sizes.get(source, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target, taken = plain_targets(sizes), {}
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size
        by.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    want = {}
    for s in sizes:
        key = (sizes[s], round(float(target[s]), 6))
        want[key] = want.get(key, 0) + math.floor(float(target[s]) + 0.5)
    assert {k: sum(r.taken for r in v) for k, v in by.items()} == want


def test_mix_of_odd_documents(spark):
    docs = odd_documents(spark).withColumn("size", F.lit("x")).withColumn("target", F.lit("x")).withColumn("key", F.lit("x"))
    docs = docs.unionByName(docs).repartition(5)
    rows = mixing.mix(docs).collect()
    check_mix(rows, [(r.source, r.text) for r in docs.collect()])
    again = mixing.mix(docs.repartition(3)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert mixing.mix(no_documents(spark)).count() == 0


def test_mix_with_sources_at_their_limits(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randint(0, 9), "en", s, 0) for s, n in (("a", 900), ("b", 3), ("c", 5), ("é", 100), ("z", 2), (None, 400)) for i in range(n)]
    rows += [(7, "same text", "en", "a", 0)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = mixing.mix(docs).collect()
    check_mix(got, [(r[3], r[1]) for r in rows])
    assert any(r.target == 3 * r.source_size and r.size for r in got) and any(0 < r.taken < r.size for r in got)
    none = mixing.mix(docs.withColumn("text", F.lit(" "))).collect()
    assert len(none) == len(rows) and all((r.size, r.target, r.taken) == (0, 0.0, 0) for r in none)


def test_op12_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    want = con.execute(queries.ORACLES["op12_source_mixing"]).fetchall()
    df = queries.op12_source_mixing(spark, SF01)
    assert sorted(map(tuple, df.collect())) == sorted(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- whitening
def plain_whitening(vectors, k=8):
    """Sums, covariances and deviations in whole numbers and fractions."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[j] for r in x) for j in range(d)]
    y = [[n * r[j] - s[j] for j in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    return n, [sum(c * c for c in r) for r in y], np.array(y, dtype=float) / n, v


def check_whitening(rows, ids, vectors, k):
    n, deviation, centred, v = plain_whitening(vectors)
    e = np.linalg.eigvalsh(v)[::-1][:k]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, []).append(r)
    w = np.zeros((n, k))
    for i, vec in enumerate(ids):
        mine = sorted(by[vec], key=lambda r: r.component)
        assert [r.component for r in mine] == list(range(1, k + 1)) and {int(r.deviation) for r in mine} == {deviation[i]} and {r.n for r in mine} == {n}
        w[i] = [r.whitened for r in mine]
        assert np.allclose([r.explained for r in mine], e / np.trace(v), rtol=1e-9)
    assert np.allclose(w.T @ w / n, np.eye(k), atol=1e-9)
    axes = np.linalg.lstsq(centred, w * np.sqrt(e), rcond=None)[0]  # the components that were projected on
    assert np.allclose(v @ axes, axes * e, atol=1e-6 * e[0]) and np.allclose((axes**2).sum(0), 1, atol=1e-6)
    assert rows[0].identity_error <= 1e-4


def test_whitening_of_the_table(spark):
    rows = queries.table(spark, SF, "embeddings").collect()
    got = queries.op13_embedding_whitening(spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitening(got.collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 8)


def test_whitening_of_odd_vectors(spark):
    rng = np.random.default_rng(0)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=3) * (1, 20, 1e4)], 1) for i in range(50)]
    odd = [(90, None, 1), (91, [1.0, None, 2.0], 1), (92, [math.nan, 0.0, 0.0], 1), (93, [math.inf, 0.0, 0.0], None), (94, [1.0, 2.0], 1), (95, [], 1)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(good + odd, schema).withColumn("x", F.lit("x")).withColumn("id", F.lit("x")).withColumn("w", F.lit("x")).repartition(4)
    check_whitening(whitening.whiten(df).collect(), [g[0] for g in good], [g[1] for g in good], 3)
    flat = spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3, schema)  # no variance: nothing to whiten
    assert whitening.whiten(flat).count() == 0 and whitening.whiten(df.limit(0)).count() == 0
    named = spark.createDataFrame([(None, [0.0, 1.0], 1), (1, [1.0, 1.0], 1), (1, [1.0, 1.0], 1)], schema)
    found = whitening.whiten(named).collect()  # one dimension varies; repeated rows count twice
    assert sorted((r.vec_id or 0, r.component, round(r.whitened, 6)) for r in found) in (
        [(0, 1, -round(math.sqrt(2), 6)), (1, 1, 0.707107), (1, 1, 0.707107)], [(0, 1, round(math.sqrt(2), 6)), (1, 1, -0.707107), (1, 1, -0.707107)])


def test_square_sums_are_exact():
    rng = random.Random(3)
    for bits in (8, 30, 50, 61):
        z = [[rng.randint(-(1 << bits), 1 << bits) for _ in range(3)] for _ in range(5000)]
        want = [sum(r[j] ** 2 for r in z) for j in range(3)]
        assert whitening.exact_square_sums(np.array(z)) == want
        assert [int(v) for v in whitening.row_square_sums(np.array(z[:4500]))] == [sum(c * c for c in r) for r in z[:4500]]
