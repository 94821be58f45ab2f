"""Mixing sources to target weights, with DataFrame operations only.

Every source gets a target: its weight's share of all words, at most ``max_epochs`` times the words it
has; what a source cannot take is shared again among the others by weight until no target is above its
limit. A source takes its whole documents as often as they fit into its target, and of one more epoch the
documents in a random order until the target is reached, the last one in part. The order is that of a
hash of the id, so a rerun takes the same words.

The order and the running word counts are distributed: small rows (id, source, size, key) are
range-sorted by (source, key), so a source with a third of all documents lies in many partitions; every
partition is summed by itself, and a source's place in it starts from the totals of the partitions
before, of which there are as many rows as partitions.

Defined results: a null text has size 0 and takes nothing; the null source is a source like any other,
last in order; rows with a null id have one key and follow each other by size; rows equal in id, source
and size are counted once with their number and come back as often; a very long text is counted whole, and
so is cut only where its source's target ends inside it; sources without words have target 0; an empty
table gives no rows. Columns beside id, text and source are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortac.llm.shared import written
from cohortac.session import broadcast_if_bounded

WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\t\n\x0b\x0c\r "
COPIES = 1 << 16


def word_count(text: Column) -> Column:
    """Number of words (what white space 0x20, 0x09-0x0D leaves); every word becomes one letter first, so
    nothing larger than the text is made."""
    letters = F.translate(F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"), SPACES, "")
    return F.length(letters).cast("long")


def sums_before(rows: DataFrame, group: list[str], order: list[Column], value: str, name: str) -> DataFrame:
    """Rows with ``before``: the sum of ``value`` over the rows of their group that come earlier in
    ``order``. Rows equal in group and order must be equal altogether."""
    dealt = rows.repartitionByRange(*[F.col(g).asc_nulls_last() for g in group], *order)
    dealt = written(dealt.withColumn("_part", F.spark_partition_id()), name)
    # One row for each partition and group in it: groups that span partitions are bounded by their number.
    totals = dealt.groupBy("_part", *group).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(F.col("_part").alias("_p"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return local.join(broadcast_if_bounded(starts), same).select(*rows.columns, (F.col("_start") + F.col("_local")).alias("before"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """(source, source_size, target) from (source, source_size): by code point, null last, the sources
    weigh ``weights`` in turn."""
    one = sizes.withColumn("_one", F.lit(1).cast("long"))
    ranked = sums_before(one, [], [F.col("source").asc_nulls_last()], "_one", "sources")
    weight = F.element_at(F.array(*[F.lit(int(w)).cast("long") for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    limit = F.col("source_size") * F.lit(int(max_epochs))
    ranked = written(ranked.select("source", "source_size", weight.alias("_w"), limit.alias("_limit")), "weights")
    rest, shares, capped = _shares(ranked, max_epochs)
    share = (F.col("_w") * F.lit(rest)).cast("double") / F.lit(float(shares)) if shares else F.lit(0.0)
    return ranked.select("source", "source_size", F.when(capped, F.col("_limit").cast("double")).otherwise(share).alias("target"))


def _shares(ranked: DataFrame, max_epochs: int) -> tuple[int, int, Column]:
    """(words left, weights left, condition of the sources at their limit) once no share is above a limit.
    Every round is one aggregate of the sources and adds at least one source to those at the limit."""
    total, shares = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
    rest, left, capped = total, shares, F.lit(False)
    while left:
        # share >= limit, in whole numbers: w * rest >= limit * left
        now = (F.col("_w").cast("decimal(38,0)") * F.lit(rest)) >= (F.col("_limit").cast("decimal(38,0)") * F.lit(left))
        held, weight = ranked.where(now).agg(F.coalesce(F.sum("_limit"), F.lit(0)), F.coalesce(F.sum("_w"), F.lit(0))).first()
        capped = now
        if (total - held, shares - weight) == (rest, left):
            break
        rest, left = total - held, shares - weight
    return rest, left, capped


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: int = 42, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per document: id, size (words), source_size, target (its source's) and taken (the
    words of it that the mix takes, repeats counted)."""
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), docs[id].cast("string")))
    rows = docs.select(docs[id].alias("id"), docs[source].alias("source"), word_count(docs[text]).alias("size"), key.alias("key"))
    sized = written(rows.groupBy("source", "key", "id", "size").agg(F.count(F.lit(1)).alias("copies")), "sizes")
    counted = sized.withColumn("words", F.col("size") * F.col("copies"))
    sizes = counted.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes, weights, max_epochs)
    placed = sums_before(counted, ["source"], [F.col("key"), F.col("id"), F.col("size")], "words", "places")
    targets = broadcast_if_bounded(targets.withColumnRenamed("source", "_source"))
    joined = placed.join(targets, placed["source"].eqNullSafe(targets["_source"]))
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / COPIES).cast("int")))
    many = joined.select("*", chunk.alias("_chunk"))
    here = F.sequence(F.col("_chunk").cast("long") * COPIES, F.least(F.col("copies"), (F.col("_chunk") + 1).cast("long") * COPIES) - 1)
    each = many.select("id", "size", "source_size", "target", "before", F.explode(here).alias("_copy"))
    budget = F.floor(F.col("target") + 0.5).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("CAST(floor(target + 0.5D) AS BIGINT) DIV source_size")).otherwise(F.lit(0)).cast("long")
    start = F.col("before") + F.col("_copy") * F.col("size")
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), budget - epochs * F.col("source_size") - start))
    return each.select(F.col("id").alias(id), "size", "source_size", "target", (epochs * F.col("size") + last).alias("taken"))
