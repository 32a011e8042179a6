"""Counts by looked-up lists of features against a plain version: short and long reads, crowded bins, features of one kind beside each other."""
import random
from collections import Counter

import pytest

from lociq.operators import counting

LIBRARIES = ["RIBO-A-1", "RNA-A-1"]


def drawn(seed):
    rng = random.Random(seed)
    spans = [(f"f{i}", rng.choice(["CDS", "gene", "rRNA"]), rng.choice(["c1", "c2"]), rng.choice("+-"), a, a + rng.choice([5, 60, 300, 2500])) for i in range(150) for a in [rng.randrange(20000)]]
    crowd = [(f"p{i}", "CDS", "c1", "+", 9000 + i % 40, 9100 + i % 7) for i in range(400)]
    reads = [(rng.choice(LIBRARIES), rng.choice(["c1", "c2"]), rng.choice("+-"), a, a + rng.choice([20, 30, 511, 512, 1500]), rng.choice([1, 1, 2]), 0) for _ in range(600) for a in [rng.choice([8990, 9050, rng.randrange(20000)])]]
    return [*spans, *crowd, ("null", "CDS", "c1", "+", None, 5)], [*reads, *reads[:50]]


@pytest.mark.parametrize("stranded", [True, False])
def test_counts(spark, stranded):
    features, reads = drawn(5)
    f = spark.createDataFrame(features, "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")
    r = spark.createDataFrame([(*x[:5], x[4] - x[3] + 1, *x[5:], 1) for x in reads], "library string, chrom string, strand string, start0 long, stop0 long, read_length long, nh long, flag int, n long")
    every, share, single = Counter(), Counter(), Counter()
    for library, chrom, strand, a, b, nh, _ in reads:
        hits = [x for x in features if x[4] is not None and x[2] == chrom and (x[3] == strand or not stranded) and x[4] <= b and x[5] >= a]
        kinds = Counter(x[1] for x in hits)
        for x in hits:
            every[x[1], x[0], library] += nh <= 1
            share[x[1], x[0], library] += 1 / (nh * kinds[x[1]])
            single[x[1], x[0], library] += kinds[x[1]] == 1
    packed = counting.collapsed(r)
    for got, want in ((counting.count_all_overlaps(packed, f, stranded), every), (counting.count_all_overlaps(packed, f, stranded, multi=True, fraction=True), share), (counting.count_single_hits(packed, f, stranded), single)):
        got = {(x.feature, x.id, x.library): x.cnt for x in got.collect()}
        want = {k: v for k, v in want.items() if v}
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_reads_aren_t_entered_in_several_bins(spark):
    """One row a read: neither a row for each size of bin nor a window over pairs."""
    features, reads = drawn(6)
    f = spark.createDataFrame(features[:100], "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")
    r = spark.createDataFrame([(*x[:4], x[3] + 30, 31, *x[5:], 1) for x in reads], "library string, chrom string, strand string, start0 long, stop0 long, read_length long, nh long, flag int, n long")
    found, rest = counting.looked_up(r, f, False, lambda h: h)
    assert rest is None
    plan = counting.count_single_hits(r, f)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode(flatten") == plan.count("Generate explode(concat") == 0 and plan.count("Window") == 1
