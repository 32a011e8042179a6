"""Track pyramids against direct sums at each level, and streamed coverage against a batch."""
import random

import numpy as np
import pytest

from lociq.operators import intervals, pyramid
from lociq.streaming import coverage


def drawn(seed, n=200, long=3000):
    """Runs that don't overlap, of two chromosomes."""
    rng, out = random.Random(seed), []
    for c in ("a", "b"):
        at = 0
        for _ in range(n):
            at += rng.choice([0, 1, 5, 400])
            size = rng.choice([1, 2, 63, 64, 65, long])
            out.append((c, at, at + size - 1, rng.choice([1.0, 2.5, -3.0, 7.0])))
            at += size
    return out


def test_levels(spark, tmp_path):
    rows = drawn(1)
    df = spark.createDataFrame([*rows, ("a", 10**7, 10**7 - 1, 1.0), ("b", 5, None, 1.0)], "chrom string, start0 long, stop0 long, depth double")
    made = pyramid.levels(df, ["chrom"], levels=8)
    pyramid.write(made, str(tmp_path / "p"), ["chrom"])
    table = spark.read.parquet(str(tmp_path / "p"))
    got = {(r.level, r.chrom, r.tile): (r["count"], r.least, r.greatest, r.total, r.squares) for r in table.collect()}
    want = {}
    for c in ("a", "b"):
        mine = [r for r in rows if r[0] == c]
        value = np.full(max(r[2] for r in mine) + 1, np.nan)
        for _, a, b, v in mine:
            value[a : b + 1] = v
        for k in range(8):
            w = 64 << k
            for t in range(len(value) // w + 1):
                x = value[t * w : (t + 1) * w]
                x = x[~np.isnan(x)]
                if len(x):
                    want[k, c, t] = (len(x), x.min(), x.max(), x.sum(), (x * x).sum())
        for start, stop, points in ((0, 100, 10), (1000, 50000, 20), (7, 10**6, 1)):
            k = pyramid.level_of(start, stop, points, levels=8)
            w = 64 << k
            found = pyramid.region(table, {"chrom": c}, start, stop, points, levels=8)
            assert k == 7 or stop // w - start // w < points
            assert sorted((r.start0 // w, r["count"]) for r in found.collect()) == sorted((t, n[0]) for (q, d, t), n in want.items() if q == k and d == c and start // w <= t <= stop // w)
            assert all(f"level={k}/" in f for f in found.inputFiles() if "level=" in f) or "PartitionFilters" in found._jdf.queryExecution().toString()
            for r in found.collect():
                x = value[r.start0 : r.stop0 + 1]
                assert np.isclose(r["mean"], np.nanmean(x)) and np.isclose(r.deviation, np.nanstd(x), atol=1e-6)
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_empty(spark):
    none = spark.createDataFrame([], "chrom string, start0 long, stop0 long, depth double")
    assert pyramid.levels(none, ["chrom"]).collect() == []


@pytest.mark.parametrize("arrivals", [1, 3, 7])
def test_streamed_coverage_equals_a_batch(spark, tmp_path, arrivals):
    rng, schema, rows = random.Random(arrivals), "chrom string, start0 long, stop0 long, n long", []
    keys, place = ["chrom"], str(tmp_path / "out")
    assert coverage.runs(spark, place, keys) is None
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    for i in range(arrivals):
        some = [(rng.choice("ab"), s, s + rng.choice([0, 30, 100000]), rng.randrange(1, 4)) for s in (rng.randrange(200000) for _ in range(100))] + [("a", None, None, 1), ("a", 5, 4, 1)]
        rows += some
        spark.createDataFrame(some, schema).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
        # The query ends and starts again between arrivals.
        q = coverage.start(stream, keys, ("start0", "stop0"), place, str(tmp_path / "cp"), "n", availableNow=True)
        q.awaitTermination(120)
        got = sorted(tuple(r) for r in coverage.runs(spark, place, keys).collect())
        every = spark.createDataFrame(rows, schema).where("stop0 >= start0")
        want = intervals.runs_of_depth(every, keys, ("start0", "stop0"), "n").select("chrom", "start0", "stop0", "depth")
        assert got == sorted(tuple(r) for r in want.collect())
