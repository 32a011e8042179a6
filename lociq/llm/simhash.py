"""SimHash near-duplicates, linked by multi-index hashing.

A fingerprint has two segments of 32 bits. If two fingerprints differ in at most 4 bits, one segment differs
in at most 2, so the balls of radius 1 around the two segment values meet. Each distinct segment value is entered under the
33 values of its ball; fingerprints that meet in a table entry are verified by their complete distance.

Entries with many fingerprints don't get all their pairs checked: first, fingerprints that share a value at distance 1 of
the whole 64 bits (so are within 2 of each other) are linked in a star; then only pairs of different components are
compared, with all but the largest component of an entry on one side. No link that could join components is left out.

No entry is gathered: entries are counted over distinct segment values, 33 at most in each, and joined to the fingerprints. An entry
that all its fingerprints are in by one flip of the same segment is dropped, as they meet under the segment itself. In crowded entries
pairs meet by the other segment: its two 16-bit halves can't both differ in more than 2 bits, so balls of radius 1 around one of them meet.

Null and empty texts have fingerprint zero, linked like any other. A null doc_id never names a component with other rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, byte_chunks, id_text, map_arrow, stored
from .graph import components
from .near import firsts, node

#: The contract's parameters: words a shingle, hash seed, bits that may differ.
SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Entries with more fingerprints than this get the star links first.
DENSE = 48
#: Entries with more than this are split by the other segment.
CROWDED = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a UTF-8 text over XXH64 of its word shingles, A-Z lower-cased; 0 without words."""
    from xxhash import xxh64_digest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int.from_bytes(xxh64_digest(joined, seed), "big")
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = [0, *(gaps + 1).tolist()], [*gaps.tolist(), len(joined)]
    n = len(words) - shingle + 1
    digests = b"".join([xxh64_digest(joined[a:b], seed) for a, b in zip(starts, ends[shingle - 1 :])])
    bits, ones = np.frombuffer(digests, np.uint8).reshape(n, 8), np.zeros(64)
    for at in range(0, n, 8192):
        part = np.unpackbits(bits[at : at + 8192], axis=1).astype(np.float32)
        ones += np.ones(len(part), np.float32) @ part
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""

    def f(batch: pa.RecordBatch) -> Iterator[dict]:
        for at, texts in byte_chunks(batch.column(1)):
            fp = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield {"doc_id": batch.column(0).slice(at, len(texts)), "fp": fp}

    return map_arrow(id_text(docs, id_col, text_col), f, "doc_id long, fp long")


def ball(value, bits: range):
    """An array of value and of value with each one of the bits flipped."""
    return F.array(value, *(value.bitwiseXOR(F.lit((1 << b) - (1 << 64) * (b == 63))) for b in bits))


def segments(fps: DataFrame) -> DataFrame:
    """fp, s: both segment values of fingerprints; the low one has the highest bit set."""
    fp = F.col("fp")
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(-(1 << 63)))
    return fps.select("fp", F.explode(F.array(F.shiftrightunsigned(fp, 32), low)).alias("s"))


def shared_entries(fps: DataFrame) -> DataFrame:
    """fp, key, n of the entries under which n distinct fingerprints meet that don't all meet under their segment itself.

    Entries are made from distinct segment values with their counts, so an entry has 33 rows at most, however many fingerprints are in it.
    """
    at = segments(fps)
    values = at.groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    by_key = Window.partitionBy("key")
    every = values.select("s", "c", F.explode(ball(F.col("s"), range(32))).alias("key"))
    every = every.withColumn("n", F.sum("c").over(by_key)).withColumn("least", F.min("s").over(by_key)).withColumn("most", F.max("s").over(by_key))
    keys = stored(every.where("n > 1 and (least <> most or s = key)").select("s", "key", "n"))
    return at.join(keys, "s").select("fp", "key", "n")


def split_by_other(comp: DataFrame, crowded: int) -> DataFrame:
    """comp(fp, key, n) with sub, under which what is in an entry meets: -1, or values around both halves of the other segment."""
    fp = F.col("fp")
    other = F.when(F.col("key") < 0, F.shiftrightunsigned(fp, 32)).otherwise(fp.bitwiseAND(F.lit(0xFFFFFFFF)))
    low = other.bitwiseAND(F.lit(0xFFFF))
    subs = F.concat(ball(F.shiftrightunsigned(other, 16), range(16)), F.transform(ball(low, range(16)), lambda x: x.bitwiseOR(F.lit(1 << 16))))
    return comp.withColumn("sub", F.explode(F.when(F.col("n") > crowded, subs).otherwise(F.array(F.lit(-1).cast("long")))))


def near(a: str, b: str, distance: int):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= distance


def linked(fps: DataFrame, distance: int = DISTANCE, dense: int = DENSE, crowded: int = CROWDED) -> DataFrame:
    """fp, root of the distinct fingerprints in fps(fp) that have a link."""
    if not 0 <= distance <= 4:
        raise ValueError("two segments with balls of radius 1 cover distances up to 4 only")
    shared = stored(shared_entries(fps))
    # Stars at distance 1 of a common value, for what lies in dense entries; exact at distances of 2 and more. A value has 65 fingerprints at most.
    crowd = shared.where(F.col("n") > dense).select("fp").distinct() if distance >= 2 else shared.limit(0).select("fp")
    fp = F.col("fp")
    hubs = crowd.select("fp", F.explode(ball(fp, range(64))).alias("hub")).withColumn("v", F.min("fp").over(Window.partitionBy("hub")))
    star = stored(components(hubs.where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()))
    comp = shared.join(star.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "key", "n", F.coalesce("root", "fp").alias("c"))
    groups = comp.groupBy("key", "c").agg(F.count(F.lit(1)).alias("m")).groupBy("key")
    mixed = stored(groups.agg(F.min("c").alias("least"), F.max("c").alias("most"), F.max(F.struct("m", "c")).alias("top")).where("least <> most").select("key", F.col("top.c").alias("largest")))
    comp = stored(comp.join(mixed, "key").select("fp", "key", "n", "c", (F.col("c") == F.col("largest")).alias("main")))
    meet = split_by_other(comp, crowded)
    left = meet.where("not main").select("key", "sub", F.col("fp").alias("a"), F.col("c").alias("u"))
    right = meet.select("key", "sub", F.col("fp").alias("b"), F.col("c").alias("v"), "main")
    across = left.join(right, ["key", "sub"]).where((F.col("u") != F.col("v")) & (F.col("main") | (F.col("a") < F.col("b"))) & near("a", "b", distance))
    links = stored(across.select("u", "v").distinct())
    joined = components(links.union(star.select(F.col("node").alias("u"), F.col("root").alias("v"))))
    return joined.select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id reachable by links) of every row."""
    rows = stored(fingerprints(docs, id_col, text_col))
    fps = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")))
    ids = fps.join(linked(fps.select("fp"), distance), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = ids.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = stored(ids.join(least, "root").select("fp", "component_id"))
    return rows.join(ids, "fp").select("doc_id", "fp", "component_id")


def links(texts: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """u, v: each node of texts(node, text) and the least node of its component, where that is another."""
    fps = stored(fingerprints(texts, "node", "text").distinct())
    roots = fps.join(linked(fps.select("fp").distinct(), distance), "fp", "left").select(F.col("doc_id").alias("u"), F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("u").alias("v"))
    return stored(roots.join(least, "root").where("u <> v").select("u", "v"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their component, null ids last. A repeated id's other texts stay."""
    texts = docs.select(node(text_col).alias("node"), F.col(text_col).alias("text"))
    fps = stored(fingerprints(texts, "node", "text").distinct())
    roots = fps.join(linked(fps.select("fp").distinct(), distance), "fp", "left")
    return firsts(docs, stored(roots.select(F.col("doc_id").alias("node"), F.coalesce("root", "fp").alias("root"))), id_col, text_col)
