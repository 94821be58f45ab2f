"""Repair of conversation structure by a lightest derivation.

A conversation is well formed when the initials of its roles, in turn order, read ``(s?(ua)+)?``: an
optional system row, then user and assistant in turns. Edits repair it: K keeps a row (cost 0), R gives it
the role that is due, user or assistant (2), D deletes it (3), I inserts an empty row of the role that is
due (2). Blank and repeated rows must be deleted; a truncated row that stays costs 1 more. The repair is
the cheapest one, and of equally cheap ones that with the least string of edit letters (``audit``).

An item says how far the rows are read and what has been said so far (nothing, system, user or
assistant); its weight is the pair (cost, audit). Knuth's agenda pops the least weight, finalises the item
and combines it: with the next row's edits, or with a neighbouring span that is final. Appending an edit
never makes a weight less, and keeps the order of two weights of one item: of two audits of equal cost over
the same rows neither begins with the other, since what one has more would be insertions, which cost.

A conversation of up to ``chunk`` rows is derived in one piece. A longer one is never gathered: its
rows, equal ones counted once, are range-sorted by (conversation, turn, role, text), cut into chunks, and
every chunk is derived on its own from each item that may come before it; neighbouring spans are then combined by
two, up to the goal. First occurrences of a text in a long conversation come from an aggregate and a join.
Only what the result holds in one cell anyway, the audit, meets in one task, and the SHA-256 of the repaired
rows, which cannot be computed in parts, streams through one.

Defined results: a null role or text counts as one space; a null conversation id is a conversation of
its own; rows of equal turn are ordered by role, then text (code points), null turns come first; a role or text that is empty
has no initial and no last character; very long texts are read whole; conversations without rows have cost 0, an
empty audit and the hash of the empty string; an empty table gives no rows. Columns beside the four named are
not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator
from itertools import groupby, islice, repeat

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortac.llm.shared import written
from cohortac.session import broadcast_if_bounded

CHUNK = 256
SPACES = " \t\n\x0b\x0c\r"
# What has been said so far: nothing, the system row, a user row, an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
DUE = {NOTHING: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ENDS = (NOTHING, ASSISTANT)
LEGAL = ("su", "ua", "au")
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED = 1

Weight = tuple[int, str]


def said(state: int, initial: str) -> int | None:
    """The state after a row of this initial is kept, or None if it may not stand here."""
    if state == NOTHING and initial == "s":
        return SYSTEM
    due, after = DUE[state]
    return after if initial == due[0] else None


def lightest(axioms: list[tuple[Weight, tuple]], combine: Callable, done: Callable = lambda item: False) -> dict[tuple, Weight]:
    """Knuth's agenda: final weights of all items up to the first that is ``done`` (of all, if none is).
    ``combine(item, weight, final)`` gives the deductions that an item newly final takes part in, as
    (size, weight, item); of equal costs the item over fewer rows is popped first."""
    agenda = [(weight[0], 0, weight[1], item) for weight, item in axioms]
    heapq.heapify(agenda)
    final: dict[tuple, Weight] = {}
    while agenda:
        cost, _, audit, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = (cost, audit)
        if done(item):
            break
        for size, weight, head in combine(item, final[item], final):
            if head not in final:
                heapq.heappush(agenda, (weight[0], size, weight[1], head))
    return final


def derive(rows: list[tuple], entry: int, goal: bool) -> dict[tuple, Weight]:
    """Items (rows read, state) from ``entry``; with ``goal`` up to the finished conversation. A row is
    (initial, must be deleted, truncated, further copies, all of which must be deleted)."""
    n = len(rows)

    def combine(item, weight, final):
        at, state = item
        cost, audit = weight
        if goal and at == n and state in ENDS:
            yield n, weight, ("goal",)
        yield at, (cost + COST[INSERT], audit + INSERT), (at, DUE[state][1])
        if at == n:
            return
        initial, doomed, cut, copies = rows[at]
        rest, more = COST[DELETE] * copies, DELETE * copies
        yield at + 1, (cost + COST[DELETE] + rest, audit + DELETE + more), (at + 1, state)
        if not doomed:
            after = said(state, initial)
            if after is not None:
                yield at + 1, (cost + COST[KEEP] + TRUNCATED * cut + rest, audit + KEEP + more), (at + 1, after)
            yield at + 1, (cost + COST[REROLE] + TRUNCATED * cut + rest, audit + REROLE + more), (at + 1, DUE[state][1])

    return lightest([((0, ""), (0, entry))], combine, lambda item: item == ("goal",))


def spans(rows: list[tuple]) -> list[tuple[int, int, int, str]]:
    """(state before, state after, cost, audit) of a chunk, for all states."""
    n = len(rows)
    return [(q, item[1], *w) for q in range(4) for item, w in derive(rows, q, False).items() if item[0] == n]


def join_spans(parts: list[list[tuple[int, int, int, str]]]) -> Weight:
    """The goal's weight from the spans of consecutive chunks: neighbours are combined by two, an agenda for
    each pair, until one span holds all rows."""
    while len(parts) > 1:
        parts = [_pair(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return min((cost, audit) for before, after, cost, audit in parts[0] if before == NOTHING and after in ENDS)


def _pair(left: list[tuple], right: list[tuple]) -> list[tuple]:
    axioms = [((c, a), (side, p, q)) for side, part in (("left", left), ("right", right)) for p, q, c, a in part]

    def combine(item, weight, final):
        side, p, q = item
        if side == "left":
            for after in range(4):
                if (found := final.get(("right", q, after))) is not None:
                    yield 1, (weight[0] + found[0], weight[1] + found[1]), ("both", p, after)
        elif side == "right":
            for before in range(4):
                if (found := final.get(("left", before, p))) is not None:
                    yield 1, (found[0] + weight[0], found[1] + weight[1]), ("both", before, q)

    return [(item[1], item[2], *w) for item, w in lightest(axioms, combine).items() if item[0] == "both"]


def repaired(audit: str, rows: Iterator[tuple[str, str]], state: int) -> Iterator[tuple[str, int]]:
    """The repaired rows as ``role:text``, each with the state after it. ``rows`` are those the edits read."""
    for edit in audit:
        role, text = next(rows) if edit != INSERT else ("", "")
        if edit in (REROLE, INSERT):
            role, state = DUE[state]
        elif edit == KEEP:
            state = said(state, role[:1])
        if edit != DELETE:
            yield f"{role}:{text}", state


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
SCHEMA = "conv string, " + ", ".join(f"{c} long" for c in NUMBERS) + ", audit string, repaired_sha256 string"
RESULTS = 1000  # result rows handed back at a time


def _rows(batches: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].tolist() for c in columns))


def _frames(results: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    while out := list(islice(results, RESULTS)):
        yield pd.DataFrame(out, columns=columns)


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))


def _repair_whole(rows: list[tuple]) -> tuple:
    """The results of a whole conversation from its (turn, role, text, initial, last), in order."""
    turns = {int(t) for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    seen: set[tuple[str, str]] = set()
    numbers, items = {"blank": 0, "duplicate": 0, "truncated": 0}, []
    pairs = [(role, text) for _, role, text, _, _ in rows]
    for pair, (_, _, _, initial, last) in zip(pairs, rows):
        fault = "blank" if last == "" else "duplicate" if pair in seen else "truncated" if last not in ".!?" else None
        seen.add(pair)
        if fault:
            numbers[fault] += 1
        items.append((initial, fault in ("blank", "duplicate"), fault == "truncated", 0))
    cost, audit = derive(items, NOTHING, True)[("goal",)]
    lines = "\n".join(line for line, _ in repaired(audit, iter(pairs), NOTHING))
    return gaps, *numbers.values(), illegal_pairs([i for i, *_ in items]), cost, audit, hashlib.sha256(lines.encode()).hexdigest()


def _short(rows: DataFrame, order: list) -> DataFrame:
    """Results of conversations of bounded length."""
    columns = ["conv", "absent", "turn", "role", "text", "initial", "last"]

    def whole(batches):
        groups = groupby(_rows(batches, columns), key=lambda r: r[0])
        yield from _frames(((conv, *_repair_whole([r[2:] for r in group if not r[1]])) for conv, group in groups), [c.split()[0] for c in SCHEMA.split(", ")])

    ordered = rows.repartition("conv").sortWithinPartitions(*order)
    return ordered.select(*[F.col(c).cast("string").alias(c) if c == "turn" else c for c in columns]).mapInPandas(whole, SCHEMA)


def _long(rows: DataFrame, order: list, chunk: int) -> DataFrame:
    """Results of conversations of any length, cut into chunks."""
    key = ["conv", "part", "chunk"]
    alike = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    unique = rows.groupBy("conv", "turn", "role", "text", "last", "initial").agg(F.count(F.lit(1)).alias("n"))
    unique = written(unique.withColumn("alike", alike), "conversation-rows")
    first = unique.groupBy(F.col("conv").alias("_conv"), F.col("alike").alias("_alike")).agg(F.min(turn).alias("_first"))
    blank, again = F.col("last") == "", turn != F.col("_first")
    told = unique.join(first, (F.col("conv") == F.col("_conv")) & (F.col("alike") == F.col("_alike"))).select(
        "conv", "turn", "role", "text", "initial", "n", blank.alias("blank"), (~blank & again).alias("again"),
        (~blank & ~again & ~F.col("last").isin(".", "!", "?")).alias("cut"),
    )

    def place(batches):
        conv, at = None, 0
        for batch in batches:
            places = []
            for c in batch["conv"]:
                conv, at = c, at + 1 if c == conv else 0
                places.append(at)
            yield batch.assign(chunk=[p // chunk for p in places], place=[p % chunk for p in places])

    ordered = told.withColumn("turn_text", F.col("turn").cast("string")).repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = ordered.drop("turn").withColumn("part", F.spark_partition_id())
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    placed = written(ordered.mapInPandas(place, f"{fields}, chunk int, place int"), "conversation-places")

    def derive_chunks(batches):
        def results():
            for at, group in groupby(_rows(batches, [*key, "initial", "blank", "again", "cut", "n"]), key=lambda r: r[:3]):
                rows = [(i, b or a, c, n - 1) for *_, i, b, a, c, n in group]
                initials, copies = [r[0] for r in rows], sum(r[3] for r in rows)
                yield (*at, len(rows) + copies, illegal_pairs(initials) + copies, initials[0], initials[-1], spans(rows))

        yield from _frames(results(), [*key, "rows", "illegal", "first", "last", "spans"])

    small = placed.select(*key, "place", "initial", "blank", "again", "cut", "n").repartition(*key).sortWithinPartitions(*key, "place")
    derived = small.mapInPandas(
        derive_chunks,
        "conv string, part int, chunk int, rows long, illegal long, first string, last string, spans array<struct<before:int,after:int,cost:long,audit:string>>",
    )

    def finish(batches):
        columns = [*key, "rows", "illegal", "first", "last", "spans"]

        def results():
            for conv, group in groupby(_rows(batches, columns), key=lambda r: r[0]):
                chunks = list(group)
                cost, audit = join_spans([[(s["before"], s["after"], s["cost"], s["audit"]) for s in c[7]] for c in chunks])
                illegal = sum(c[4] for c in chunks) + sum(a[6] + b[5] not in LEGAL for a, b in zip(chunks, chunks[1:]))
                at = 0
                for number, c in enumerate(chunks):
                    end = len(audit) if number + 1 == len(chunks) else _after_rows(audit, at, c[3])
                    yield (conv, c[1], c[2], cost, illegal, audit[at:end])
                    at = end

        yield from _frames(results(), [*key, "cost", "illegal", "audit"])

    pieces = written(
        derived.repartition("conv").sortWithinPartitions(*key).mapInPandas(finish, "conv string, part int, chunk int, cost long, illegal long, audit string"), "conversation-edits"
    )
    in_order = F.array_sort(F.collect_list(F.struct("part", "chunk", "audit")))
    edits = pieces.groupBy("conv").agg(
        F.max("cost").alias("cost"), F.max("illegal").alias("illegal"), F.array_join(F.transform(in_order, lambda x: x["audit"]), "").alias("audit")
    )

    def hashes(batches):
        def results():
            for conv, group in groupby(_rows(batches, [*key, "role", "text", "n", "audit"]), key=lambda r: r[0]):
                digest, begun, state, at, rest = hashlib.sha256(), False, NOTHING, None, ""
                for _, part, number, role, text, n, audit in group:
                    if at != (part, number):
                        at, rest = (part, number), audit
                    end = _after_rows(rest, 0, n)
                    if not rest[end:].strip(INSERT):  # after the last row: the insertions that end the conversation
                        end = len(rest)
                    for line, state in repaired(rest[:end], repeat((role, text)), state):
                        digest.update((b"\n" if begun else b"") + line.encode())
                        begun = True
                    rest = rest[end:]
                yield conv, digest.hexdigest()

        yield from _frames(results(), ["conv", "repaired_sha256"])

    with_edits = placed.select(*key, "place", "role", "text", "n").join(pieces.select(*key, "audit"), key)
    digests = with_edits.repartition("conv").sortWithinPartitions(*key, "place").mapInPandas(hashes, "conv string, repaired_sha256 string")
    known = F.col("turn_text").cast("long")
    gaps = F.coalesce(F.max(known) - F.min(known) + 1 - F.count_distinct(known), F.lit(0).cast("long"))
    numbers = placed.groupBy("conv").agg(
        gaps.alias("gaps"),
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("n") - F.when(F.col("again"), 0).otherwise(1)).otherwise(0)).alias("duplicate"),
        F.count_if("cut").alias("truncated"),
    )
    found = numbers.join(edits, "conv").join(digests, "conv")
    return found.select("conv", *NUMBERS, "audit", "repaired_sha256")


def _after_rows(audit: str, at: int, rows: int) -> int:
    """Place in the audit after the edits of the next ``rows`` rows (insertions before a row are its own)."""
    while rows:
        rows -= audit[at] != INSERT
        at += 1
    return at


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", absent: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation: its id, gaps (turns missing between the first and the last), rows that are
    blank, duplicate (same role and text seen earlier) or truncated (last character not ``.!?``; a row's first
    fault counts), illegal (neighbours whose initials are not su, ua, au), the cost and the audit of the
    lightest repair and the SHA-256 of the repaired ``role:text`` lines. Rows that are ``absent`` only say
    that their conversation exists."""
    name = F.coalesce(F.concat(F.lit("="), rows[conv].cast("string")), F.lit(""))
    gone = F.lit(False) if absent is None else absent
    one = rows.select(
        name.alias("conv"), gone.alias("absent"), rows[turn].cast("long").alias("turn"), F.coalesce(rows[role], F.lit(" ")).alias("role"), F.coalesce(rows[text], F.lit(" ")).alias("text")
    )
    marked = one.select("*", F.left("role", F.lit(1)).alias("initial"), F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1)).alias("last"))
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "text"]
    lengths = marked.groupBy("conv").agg(F.count_if(~F.col("absent")).alias("rows"))
    long = written(lengths.where(F.col("rows") > chunk).select("conv"), "long-conversations")
    n_long = long.count()
    if not n_long:
        found = _short(marked, order)
    else:
        named = broadcast_if_bounded(long, known_rows=n_long)
        short = _short(marked.join(named, "conv", "left_anti"), order)
        found = short.unionByName(_long(marked.where(~F.col("absent")).join(named, "conv", "left_semi"), order, chunk))
    id = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(rows.schema[conv].dataType)
    return found.select(id.alias(conv), *NUMBERS, "audit", "repaired_sha256")
