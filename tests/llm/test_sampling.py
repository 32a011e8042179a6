"""Mixing to targets against a plain version, the given SQL, and awkward rows."""
import hashlib
import math

import duckdb
import pytest
from pyspark.sql import functions as F

from lociq.llm import queries, sampling

SCHEMA = "doc_id long, text string, source string, size string, copies int, rank int, row int, __at long"


def words(text):
    return len((text or "").encode().translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ")) - (text or "").encode().translate(bytes.maketrans(b"\t\n\v\f\r", b"     ")).split(b" ").count(b"")


def plain_targets(sizes, weights=(1, 2, 3), ceiling=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (total - sum(ceiling * sizes[s] for s in capped)) / sum(w[s] for s in free) if free else 0.0
        more = {s for s in free if w[s] * level > ceiling * sizes[s]}
        if not more:
            return {s: float(ceiling * sizes[s]) if s in capped else w[s] * level for s in order}
        capped |= more


def plain(rows, seed=42):
    """(doc_id, size, source_size, target, copies) of (doc_id, text, source) rows."""
    by = {}
    for i, text, source in rows:
        by.setdefault(source, []).append((i, words(text)))
    sizes = {s: sum(n for _, n in x) for s, x in by.items()}
    goal, out = plain_targets(sizes), []
    for s, x in by.items():
        md5 = lambda t: hashlib.md5(f"{seed}:{t}".encode()).hexdigest()
        x.sort(key=lambda r: (-r[1], md5("" if r[0] is None else r[0])))
        rate, u = goal[s] / sizes[s] if sizes[s] else 0.0, int(md5("" if s is None else "=" + s)[:8], 16) / 2**32
        for k, (i, n) in enumerate(x, 1):
            out.append((i, n, sizes[s], goal[s], math.floor(k * rate + u) - math.floor((k - 1) * rate + u)))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4) for r in rows], SCHEMA)


def got(df):
    return sorted([(r.doc_id, r["size"], r.source_size, r.target, r.copies) for r in df.collect()], key=str)


def close(a, b):
    return len(a) == len(b) and all(x[:3] == y[:3] and x[4] == y[4] and math.isclose(x[3], y[3], rel_tol=1e-12) for x, y in zip(a, b))


ROWS = [(i, "w " * (i * 7 % 23), f"s{i % 5}") for i in range(300)] + [(i, "one two", "tiny") for i in range(300, 303)]
AWKWARD = [(1, None, None), (2, "", "a"), (3, " \t\n", "a"), (None, "a b c", None), (None, "a b c", None), (4, "x\vy\fz", "é"), (5, "word " * 50000, "é"), (6, "a b", ""), (6, "a b", ""), (7, None, "zero")]


@pytest.mark.parametrize("rows", [ROWS, AWKWARD, [(1, None, "a"), (2, "", None)], []])
def test_as_a_plain_version(spark, rows):
    assert close(got(sampling.shares(frame(spark, rows))), plain(rows))


def test_targets_near_and_order_free(spark):
    docs = frame(spark, ROWS)
    out = sampling.shares(docs).cache()
    for r in out.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target"), F.max("size").alias("most"), F.max("copies").alias("copies")).collect():
        assert abs(r.taken - r.target) <= r.most and r.copies <= 3
    again = sampling.shares(docs.repartition(7, F.rand(3)))
    assert got(again) == got(out)


def test_the_mix_repeats_rows(spark):
    docs = frame(spark, ROWS + AWKWARD)
    want = sampling.shares(docs).agg(F.sum("copies")).first()[0]
    out = sampling.mixed(docs)
    assert out.columns == docs.columns and out.count() == want
    assert out.where("size <> 'x' or copies <> 1 or `__at` <> 4").count() == 0


def test_one_source_holds_nearly_all(spark):
    """A hot source of rows that are all alike: ranks run through all ranges, and no task sorts it whole."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few bytes
    docs = spark.range(60000).select(F.when(F.col("id") > 50, F.lit(None)).otherwise(F.col("id")).alias("doc_id"), F.lit("three words here").alias("text"), F.when(F.col("id") < 3, "b").otherwise("a").alias("source"))
    rows = sampling.arranged(docs.select(*sampling.sized(docs, "doc_id", "text", "source"), F.monotonically_increasing_id().alias("salt")), ["source"], [F.col("size").desc(), F.col("salt")])
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per = rows.groupBy(F.floor(F.col("__at") / sampling.RANGE)).count().collect()
    assert len(per) >= 3 and max(r["count"] for r in per) < 30000
    ranks = sampling.ranked(rows, ["source"]).groupBy("source").agg(F.count_distinct("rank").alias("n"), F.max("rank").alias("most"), F.min("rank").alias("least")).collect()
    assert {(r.source, r.n, r.most, r.least) for r in ranks} == {("a", 59997, 59997, 1), ("b", 3, 3, 1)}
    taken = sampling.shares(docs).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 3 for r in taken)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_as_its_sql(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '/root/testdata/{sf}/documents.parquet'")
    want = sorted(duckdb.sql(queries.oracle_sql()["op11_mixing"]).project("doc_id, size, source_size, target, taken").fetchall())
    assert sorted(tuple(r) for r in queries.op11_mixing(spark, f"/root/testdata/{sf}").collect()) == want
