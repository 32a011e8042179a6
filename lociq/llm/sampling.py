"""Mixing sources to target weights by systematic sampling.

1. Sizes are words, [^\\x20\\x09-\\x0D]+; a source's weight follows its place in code-point order (null last), repeating.
2. Targets share the sum of all sizes by weight; one above `ceiling` times its source's size stops there, and its excess is shared again by
   weight until none is above.
3. A source's documents all have the same expected copies, target / source size, so their prefix sum is rank * rate. With one random
   offset a source, a document is emitted once for each integer that its step of the sum crosses: floor(rate) or ceil(rate) times.

Documents are ranked by falling size, then by a hash of the id, so what a source's taken words miss of its target is less than its
longest document. Ranks come from one range sort of narrow rows, numbered by ranges that are shifted by the counts before them; a hot source
is many ranges. The result depends on ids, sources and sizes only, neither on the order of rows nor on their partitions.

Null and empty texts have size 0 and share in the copies. A null source is a source of its own, in the last place. Repeated rows are documents of
their own; rows alike in id, source and size have interchangeable results. Sources without words have target 0 and no copies. An empty table
gives an empty result.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: The contract's parameters, and what the random offsets and the order of ties are drawn from.
WEIGHTS, CEILING, SEED = (1, 2, 3), 3, 42
WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a range have numbers below this (monotonically_increasing_id).
RANGE = 1 << 33


def draw(value: Column, seed: int = SEED) -> Column:
    """A number from 0 to below 1 that depends on the seed and a text only."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), value).cast("binary")), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def arranged(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """A table of rows, range-sorted by group and order; __at numbers them with gaps between ranges."""
    keys = [x for c in group for x in (F.col(c).isNull(), F.col(c))] + order
    return stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", F.monotonically_increasing_id()))


def ranked(rows: DataFrame, group: list[str]) -> DataFrame:
    """An arranged table with `rank`, 1 and on within a group: numbers within ranges, shifted by the counts of the ranges before."""
    band = F.floor(F.col("__at") / RANGE)
    ranges = rows.groupBy(band.alias("__band"), *group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.col("__first") - F.coalesce(F.sum("__n").over(before), F.lit(0))
    ranges = ranges.select("__band", *(F.col(c).alias(f"__g{c}") for c in group), shift.alias("__shift"))
    same = [F.col(c).eqNullSafe(F.col(f"__g{c}")) for c in group]
    found = rows.withColumn("__of", band).join(ranges, [F.col("__of") == F.col("__band"), *same])
    return found.withColumn("rank", F.col("__at") - F.col("__shift") + 1).drop("__at", "__of", "__band", "__shift", *(f"__g{c}" for c in group))


def targets(rows: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING) -> DataFrame:
    """source, source_size, target of rows(source, size)."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int")
    weighed = ranked(arranged(sizes, [], [F.col("source").isNull(), F.col("source")]), [])
    weighed = stored(weighed.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long").alias("weight")))
    total = weighed.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    full, capped, level = ceiling * F.col("source_size"), -1, 0.0
    while True:  # sources only ever join those that stop, so the level only rises
        stops = F.col("weight") * F.lit(level) > full
        taken, n, free = weighed.agg(F.coalesce(F.sum(F.when(stops, full)), F.lit(0)), F.count(F.when(stops, 1)), F.coalesce(F.sum(F.when(~stops, F.col("weight"))), F.lit(0))).first()
        if n == capped or not free:
            break
        level, capped = (total - taken) / free, n
    return weighed.select("source", "source_size", F.when(stops, full.cast("double")).otherwise(F.col("weight") * F.lit(level)).alias("target"))


def planned(rows: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED) -> DataFrame:
    """rows(doc_id, source, size and others) with source_size, target and copies."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    # The last key splits rows that are alike, which are interchangeable.
    rows = rows.withColumn("__salt", F.monotonically_increasing_id())
    rows = arranged(rows, ["source"], [F.col("size").desc(), F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")), F.col("__salt")]).drop("__salt")
    found = ranked(rows, ["source"])
    goals = targets(rows, weights, ceiling).withColumnRenamed("source", "__source")
    found = found.join(goals, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Null's own text can't be another source's: those begin with "=".
    offset = draw(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")), seed)
    upto = lambda k: F.floor(k * rate + offset)
    return found.withColumn("copies", (upto(F.col("rank")) - upto(F.col("rank") - 1)).cast("long")).drop("rank")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")]


def shares(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, copies of every row."""
    return planned(docs.select(*sized(docs, id_col, text_col, source_col)), weights, ceiling, seed)


def mixed(docs: DataFrame, weights: Sequence[int] = WEIGHTS, ceiling: int = CEILING, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix: rows of docs, with all their columns, each as often as it is taken."""
    rows = docs.select(*sized(docs, id_col, text_col, source_col), F.struct(*docs.columns).alias("row"))
    out = planned(rows, weights, ceiling, seed).where("copies > 0")
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
