"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Each input partition (block) takes a short fingerprint of each normalised text, cut to about log2(rows) + 14 bits.
2. It sorts its distinct fingerprints and sends each owner, a range of fingerprints, its part as a Golomb-Rice code.
3. An owner decodes the sorted lists of all blocks and answers each with a bitmap: which are held elsewhere too.
4. Only rows under a set bit, or with a fingerprint that their own block holds twice, are suspects. Their texts
   are shuffled and compared byte by byte, first within salts, then between one representative of each salt, so that no
   task gets a hot group whole.

Texts are equal when identical after each run of white space becomes one space. Null texts count as empty, and
empty texts equal each other. Of equal texts the row with the smallest doc_id stays; a null doc_id comes after all others. Where
rows repeat a doc_id with equal text, one of them stays. An empty table gives an empty result.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, id_text, stored

#: Rows of one owner's range, about.
OWNER_ROWS = 2_000_000


def rice_encode(gaps: np.ndarray, k: int) -> tuple[bytes, bytes]:
    """Golomb-Rice code with divisor 2**k: unary quotients, and remainders of k bits."""
    q = (gaps >> np.uint64(k)).astype(np.int64)
    unary = np.ones(int(q.sum()) + len(q), np.uint8)
    unary[np.cumsum(q + 1) - 1] = 0
    bits = np.unpackbits(gaps.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)[:, 64 - k :]
    return np.packbits(unary).tobytes(), np.packbits(bits.ravel()).tobytes()


def rice_decode(unary: bytes, rest: bytes, k: int, n: int) -> np.ndarray:
    zeros = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)) == 0)[:n]
    q = np.diff(zeros, prepend=-1) - 1
    bits = np.zeros((n, 64), np.uint8)
    bits[:, 64 - k :] = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k)
    return (q.astype(np.uint64) << np.uint64(k)) | np.packbits(bits, axis=1).view(">u8").ravel().astype(np.uint64)


def parts(fingerprints: np.ndarray, owners: int, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(owner, its sorted distinct fingerprints): equal ranges of the width-bit fingerprints."""
    u = np.unique(fingerprints)
    who = (u * np.uint64(owners)) >> np.uint64(width)
    cuts = np.flatnonzero(np.diff(who)) + 1
    for x in np.split(u, cuts) if len(u) else ():
        yield int((x[0] * np.uint64(owners)) >> np.uint64(width)), x


def suspects(rows: DataFrame, n_rows: int, owners: int | None = None) -> DataFrame:
    """doc_id, fp of the rows in (block, doc_id, fp) whose fingerprint another row seems to share."""
    spark = rows.sparkSession
    owners = owners or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n_rows / OWNER_ROWS))
    width = min(50, max(24, n_rows.bit_length() + 14))  # owners * 2**width stays under 2**64

    def cut(fp: pd.Series) -> np.ndarray:
        return fp.to_numpy().view(np.uint64) >> np.uint64(64 - width)

    def send(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for owner, x in parts(cut(pdf.fp), owners, width):
            base = np.uint64(-(-(owner << width) // owners))
            gaps = np.diff(x, prepend=base)
            k = max(1, int(np.log2(max(1.0, float(gaps.mean())))))
            out.append((pdf.block.iat[0], owner, len(x), k, *rice_encode(gaps, k)))
        return pd.DataFrame(out, columns=["block", "owner", "n", "k", "unary", "rest"])

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        base = np.uint64(-(-(int(pdf.owner.iat[0]) << width) // owners))
        lists = [base + np.cumsum(rice_decode(r.unary, r.rest, r.k, r.n), dtype=np.uint64) for r in pdf.itertuples()]
        u, n = np.unique(np.concatenate(lists), return_counts=True)
        twice = u[n > 1]
        bitmaps = [np.packbits(np.isin(x, twice, assume_unique=True)).tobytes() for x in lists]
        return pd.DataFrame({"block": pdf.block, "owner": pdf.owner, "n": pdf.n, "bitmap": bitmaps})

    def apply(pdf: pd.DataFrame, maps: pd.DataFrame) -> pd.DataFrame:
        fp = cut(pdf.fp)
        u, n = np.unique(fp, return_counts=True)
        maps = maps.sort_values("owner")
        found = n > 1
        if len(maps):
            found |= np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8))[:m] for b, m in zip(maps.bitmap, maps.n)]).astype(bool)
        return pdf.loc[np.isin(fp, u[found]), ["doc_id", "fp"]]

    blocks = rows.groupBy("block")
    sent = blocks.applyInPandas(send, "block long, owner long, n long, k int, unary binary, rest binary")
    maps = sent.groupBy("owner").applyInPandas(answer, "block long, owner long, n long, bitmap binary")
    return blocks.cogroup(maps.groupBy("block")).applyInPandas(apply, "doc_id long, fp long")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int | None = None, owners: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 of every row.

    salts: parts of a group of equal texts; by default 64, and more where these would have over a million rows if all rows were equal.
    """
    normal = id_text(docs, id_col, text_col).select("doc_id", F.regexp_replace("text", SPACE + "+", " ").alias("t"))
    rows = stored(normal.select(F.spark_partition_id().cast("long").alias("block"), F.monotonically_increasing_id().alias("row"), "doc_id", F.xxhash64("t").alias("fp"), F.sha2("t", 256).alias("text_sha256")))
    n_rows = rows.count()
    salts = salts or max(64, math.ceil(n_rows / 1_000_000))
    found = stored(suspects(rows.select("block", "doc_id", "fp"), n_rows, owners).select("doc_id").distinct())
    # Byte verification: equal texts of a salt choose a representative, those of all salts the row that stays.
    order = F.coalesce("doc_id", F.lit(2**63 - 1))
    # Salts are dealt by row, so rows of one id, or without any, are spread too.
    some = normal.select(order.alias("key"), "t", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("salt")).join(found.select(order.alias("key")), "key", "left_semi")
    by_salt = Window.partitionBy("salt", "t")
    first = F.row_number().over(by_salt.orderBy("key"))
    inner = stored(some.select("key", "salt", "t", F.min("key").over(by_salt).alias("rep"), F.count(F.lit(1)).over(by_salt).alias("n"), first.alias("rank")).select("key", "salt", "rep", F.sha2("t", 256).alias("text_sha256"), F.when(F.col("rank") == 1, F.col("n")).alias("n"), F.when(F.col("rank") == 1, F.col("t")).alias("t")))
    by_text = Window.partitionBy("t")
    reps = inner.where("n is not null").select("salt", "rep", "text_sha256", F.min("rep").over(by_text).alias("keep"), F.sum("n").over(by_text).alias("size"))
    verdict = inner.select("key", "salt", "rep", "text_sha256").distinct().join(reps, ["salt", "rep", "text_sha256"]).select("key", "text_sha256", "keep", "size").where("size > 1").distinct()
    # Of rows that repeat id and text the first stays.
    again = rows.groupBy(order.alias("key"), "text_sha256").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1").drop("times")
    out = rows.withColumn("key", order).join(verdict, ["key", "text_sha256"], "left").join(again, ["key", "text_sha256"], "left")
    keep = F.nullif(F.coalesce("keep", "key"), F.lit(2**63 - 1))
    kept = (F.col("key") == F.coalesce("keep", "key")) & (F.col("row") == F.coalesce("first", "row"))
    return out.select("doc_id", keep.alias("keep_id"), F.coalesce("size", F.lit(1)).cast("long").alias("group_size"), kept.alias("kept"), "text_sha256")


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, with all their columns, that stay."""
    out = stored(exact_duplicates(docs, id_col, text_col))
    again = out.where(~F.col("kept") & F.col("doc_id").eqNullSafe(F.col("keep_id")))  # whole rows that repeat
    stays = out.where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    lost = out.where(~F.col("kept")).select("doc_id", "text_sha256").join(stays, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_sha256") == F.col("sha")), "left_anti")
    key = F.sha2(F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE + "+", " "), 256)
    lost = stored(lost.distinct().select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha")))
    # The same join at every size: the rows that go grow with the input, so they are shuffled, not broadcast where they happen to be few.
    lost = lost.hint("merge")
    kept = docs.join(lost, docs[id_col].eqNullSafe(lost["__id"]) & (key == lost["__sha"]), "left_anti")
    if again.isEmpty():
        return kept
    return kept.withColumn("__sha", key).dropDuplicates([id_col, "__sha"]).drop("__sha")
