"""Near copies by the Jaccard similarity of their word shingles: MinHash bands find pairs, the shingles themselves decide.

Two texts are linked when the sets of their five-word shingles (A-Z lower-cased; a shorter text is one shingle) have
a similarity of 0.8 or more. A pair at 0.8 shares one of the 24 bands of five minima with a probability of 0.9999, and
a pair above with a greater one. No found pair is linked without comparing the sets.

A table entry's texts aren't all compared: first each is compared with one hub, another in every band. Texts that are then in an entry with texts of
other components are searched by an exact prefix filter, which finds all their pairs over the similarity: shingles of one component only come first, then rare
ones; the first that a pair shares is among the first ninth of the smaller text's and the first fifth of the other's (at 0.8), and leaves each enough
shingles behind it. So near copies that differ too much to be linked make no pairs, however many they are. No entry is cut.

Links that another method found can be given: they join components from the start, and what they joined isn't searched.

Null and empty texts have no shingle and equal each other. Rows that repeat are one text; an empty table gives an empty result.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, byte_chunks, id_text, map_arrow, stored
from .graph import components

#: Words a shingle, the least similarity as a fraction, hash seed, and the bands with their minima.
SHINGLE, LEAST, SEED, BANDS, ROWS = 5, (4, 5), 42, 24, 5


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct XXH64 values of a UTF-8 text's word shingles."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    return np.unique(np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[min(shingle, len(words)) - 1 :])], np.uint64))


def multipliers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 2**64, (2, BANDS * ROWS, 1), np.uint64)
    return a | np.uint64(1), b


def bands(values: np.ndarray, by: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The key of each band, with the band in its hash."""
    from xxhash import xxh64_intdigest

    low = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(values), 4096):
        low = np.minimum(low, (values[at : at + 4096] * by[0] + by[1]).min(axis=1))
    return np.array([xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(low.reshape(BANDS, ROWS))], np.uint64).view(np.int64)


def node(text: str) -> Column:
    """What stands for a text: equal texts have equal nodes."""
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


def entries(texts: DataFrame) -> DataFrame:
    """node, key: the table entries of texts(node, text)."""

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        by = multipliers()
        for at, some in byte_chunks(batch.column(1)):
            yield {"node": batch.column(0).slice(at, len(some)), "keys": [bands(shingles(t), by) for t in some]}

    found = stored(map_arrow(id_text(texts, "node"), f, "node long, keys array<long>"))
    return found.select("node", F.explode("keys").alias("key")).distinct()


def sets(texts: DataFrame) -> DataFrame:
    """node, grams: the shingles of texts(node, text), each node once."""

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        for at, some in byte_chunks(batch.column(1), 1 << 21):
            yield {"node": batch.column(0).slice(at, len(some)), "grams": [shingles(t).view(np.int64) for t in some]}

    return map_arrow(id_text(texts, "node"), f, "node long, grams array<long>").dropDuplicates(["node"])


def alike(pairs: DataFrame, grams: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """The pairs(u, v) whose sets are similar enough, in whole numbers."""
    a, b = (grams.select(F.col("node").alias(x), F.col("grams").alias(f"g{x}")) for x in "uv")
    both = F.size(F.array_intersect("gu", "gv"))
    either = F.size("gu") + F.size("gv") - both
    return pairs.join(a, "u").join(b, "v").where(both * least[1] >= either * least[0]).select("u", "v")


def candidates(comp: DataFrame, grams: DataFrame, least: tuple[int, int] = LEAST) -> DataFrame:
    """u, v: pairs of nodes of different components in comp(node, c), among them all whose sets in grams(node, grams) are similar enough."""
    n, d = least
    up = lambda a, b: F.ceil(a / F.lit(b))
    held = comp.join(grams, "node").select("node", "c", F.size("grams").alias("size"), "grams")
    each = held.select("node", "c", F.explode("grams").alias("token"))
    often = each.groupBy("token").agg(F.count(F.lit(1)).alias("m"), (F.min("c") != F.max("c")).alias("mixed"))
    # One order of all shingles: those that can't join components, then rare ones.
    order = F.sort_array(F.collect_list(F.struct("mixed", "m", "token")))
    first = each.join(often, "token").groupBy("node").agg(order.alias("order")).join(held.select("node", "c", "size"), "node")
    first = first.withColumn("order", F.slice("order", F.lit(1), (F.col("size") - up(n * F.col("size"), d) + 1).cast("int")))
    first = first.select("node", "c", "size", F.posexplode("order").alias("at", "x")).where("x.mixed").select("node", "c", "size", "at", "x.token")
    per = first.groupBy("token", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("token").agg(F.max(F.struct("m", "c"))["c"].alias("top"), F.count(F.lit(1)).alias("k")).where("k > 1").drop("k")
    first = stored(first.join(per, "token").withColumn("main", F.col("c") == F.col("top")).drop("top"))
    small = first.where(F.col("at") <= F.col("size") - up(2 * n * F.col("size"), n + d))
    large = first.select("token", *(F.col(c).alias(f"{c}2") for c in ("node", "c", "size", "at", "main")))
    enough = F.least(F.col("size") - F.col("at"), F.col("size2") - F.col("at2")) >= up(n * (F.col("size") + F.col("size2")), n + d)
    fits = (F.col("c") != F.col("c2")) & (F.struct("size", "node") < F.struct("size2", "node2")) & (F.col("size") * d >= F.col("size2") * n) & enough
    # All but a shingle's largest component on one side.
    found = [a.join(b, "token").where(fits).select(F.least("node", "node2").alias("u"), F.greatest("node", "node2").alias("v")) for a, b in ((small.where("not main"), large), (small.where("main"), large.where("not main2")))]
    return found[0].union(found[1]).distinct()


def linked(texts: DataFrame, least: tuple[int, int] = LEAST, given: DataFrame | None = None) -> DataFrame:
    """node, root of the nodes in texts(node, text) that have a link, those of given(u, v) included."""
    every = entries(texts)
    # The hub of an entry is drawn by its key, so a text meets a different one in each band.
    hub = F.min(F.struct(F.xxhash64("node", "key").alias("draw"), "node"))
    hubs = every.groupBy("key").agg(hub["node"].alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    shared = stored(every.join(hubs, "key"))
    grams = stored(sets(texts.join(shared.select("node").distinct().hint("merge"), "node", "left_semi")))
    tried = stored(shared.where("node <> hub").select(F.least("node", "hub").alias("u"), F.greatest("node", "hub").alias("v")).distinct())
    star = alike(tried, grams, least)
    star = stored(star if given is None else star.union(given.select("u", "v")))
    comp = stored(shared.select("node", "key").join(components(star), "node", "left").select("node", "key", F.coalesce("root", "node").alias("c")))
    mixed = comp.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high").select("key")
    apart = stored(comp.join(mixed, "key", "left_semi").select("node", "c").distinct())
    across = stored(candidates(apart, grams, least).join(tried, ["u", "v"], "left_anti"))
    return components(stored(star.union(alike(across, grams, least))))


def firsts(docs: DataFrame, roots: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that are the first by id of their component in roots(node, root), null ids last.

    A text without a root is a component of its own. Rows that repeat both id and text stay or go together.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), node(text_col).alias("node"))
    key = F.coalesce("id", F.lit(2**63 - 1)).alias("key")
    groups = rows.groupBy("node").agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("m")).join(roots, "node", "left")
    groups = stored(groups.where("root is not null or m > 1").select("node", "first", F.coalesce("root", "node").alias("root")))
    best = groups.groupBy("root").agg(F.min(F.struct("first", "node")).alias("best"))
    found = rows.select("id", "node", key).join(groups.join(best, "root").select("node", "best").hint("merge"), "node")
    lost = found.where((F.col("key") != F.col("best.first")) | (F.col("node") != F.col("best.node")))
    lost = stored(lost.select(F.col("id").alias("__id"), F.col("node").alias("__node")).distinct()).hint("merge")
    return docs.join(lost, docs[id_col].eqNullSafe(lost["__id"]) & (node(text_col) == lost["__node"]), "left_anti")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: tuple[int, int] = LEAST, others: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their component; others: what gives more links(u, v) of texts(node, text)."""
    texts = docs.select(node(text_col).alias("node"), F.col(text_col).alias("text"))
    return firsts(docs, stored(linked(texts, least, others and others(texts))), id_col, text_col)
