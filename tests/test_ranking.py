"""Ranks, mean ranks and adjusted p-values with many ties, against plain versions; bands stay small."""
import random

from pyspark.sql import functions as F

from lociq.operators import expression, predictions, ranking


def drawn(seed, n=3000):
    rng = random.Random(seed)
    return [(i, rng.choice(["a", "a", "a", "b", None]), rng.choice([0.0, 0.001, 0.5, 1.0, 1.0, 1.0, None, float("nan"), rng.random()])) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, g string, p double").repartition(5)


def test_ranked(spark):
    rows = [r for r in drawn(1) if r[2] is None or r[2] == r[2]]
    got = {r.id: (r.rank, r.ones) for r in ranking.ranked(frame(spark, rows), ["g"], [F.asc_nulls_last("p"), F.col("id")], counted={"ones": F.col("p") == 1}).collect()}
    for g in ("a", "b", None):
        some, ones = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is None, r[2] or 0, r[0])), 0
        for k, (i, _, p) in enumerate(some, 1):
            ones += p == 1
            assert got[i] == (k, ones)


def test_mean_ranks(spark):
    rows = [r for r in drawn(2) if r[2] is None or r[2] == r[2]]
    got = {r.id: r.rank for r in ranking.mean_ranked(frame(spark, rows), ["g"], "p").collect()}
    assert len(got) == len(rows)
    for g in ("a", "b", None):
        some = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2] is not None, r[2] or 0))
        places = {}
        for k, r in enumerate(some, 1):
            places.setdefault(r[2], []).append(k)
        assert all(got[r[0]] == sum(places[r[2]]) / len(places[r[2]]) for r in some)


def test_step_up(spark):
    rows = drawn(3)
    for group in ([], ["g"]):
        got = {r.id: r.padj for r in ranking.step_up(frame(spark, rows), "p", group).collect()}
        assert len(got) == len(rows)
        for g in ("a", "b", None) if group else ("all",):
            some = sorted((r for r in rows if (not group or r[1] == g) and r[2] is not None and r[2] == r[2]), key=lambda r: r[2])
            low = 1.0
            for k in range(len(some), 0, -1):
                low = min(low, some[k - 1][2] * len(some) / k)
                assert abs(got[some[k - 1][0]] - low) < 1e-12
        assert all(got[i] is None for i, _, p in rows if p is None or p != p)


def test_ties_don_t_share_a_band(spark):
    """40000 equal scores and p-values of 1 spread over bands."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        x = spark.range(40000).select(F.lit("c").alias("chrom"), F.col("id").alias("start1"), F.col("id").alias("stop1"), F.lit("+").alias("strand"), F.lit(1.0).alias("pred"), F.lit(1.0).alias("padj"), F.lit(-1).alias("dist"), F.lit("k").alias("contrast"), "id")
        bands = ranking.arranged(x.select("pred"), [], [F.col("pred")]).groupBy("__band").count().collect()
        assert len(bands) >= 3 and max(r["count"] for r in bands) < 20000
        assert predictions.ranked(x).where("pred_rank = novel_rank and pred_rank = start1 + 1").count() == 40000
        assert expression.sorted_results(x, "contrast", "id").where("place = id + 1").count() == 40000
        assert ranking.mean_ranked(x.withColumn("library", F.lit("l")), ["library"], "pred").select("rank").distinct().collect()[0].rank == 20000.5
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty(spark):
    none = frame(spark, [])
    assert ranking.step_up(none, "p", ["g"]).collect() == ranking.mean_ranked(none, ["g"], "p").collect() == ranking.ranked(none, [], [F.col("p")]).collect() == []


def test_step_up_goes_through_a_band_once(spark):
    """A frame that begins at the row costs the square of a band."""
    plan = ranking.step_up(frame(spark, drawn(4, 100)), "p", ["g"])._jdf.queryExecution().toString()
    assert "Window" in plan and "unboundedfollowing" not in plan.lower()
