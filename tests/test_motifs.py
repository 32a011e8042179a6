"""Motif hits over tiles of every size against a plain scan from the left end."""
import random

import pytest
from pyspark.sql import functions as F

from lociq.operators import motifs

NAMES = ["GTG", "ATG", "AA", "GTGTG", "AAGG", "T", "GATTACAGATTACA", "ACACACAC"]


def plain(text, motif):
    out, at = [], text.find(motif)
    while at >= 0:
        out.append(at)
        at = text.find(motif, at + len(motif))
    return out


def texts():
    rng = random.Random(5)
    out = ["ACGTATGGTGTGATTGAAGG", "", None, "G", "GTG" * 30, "GT" * 50, "A" + "GT" * 41 + "GCC" + "TG" * 30, "A" * 41, "AC" * 60, "NNGTGNgtg", "GATTACA" * 20]
    return out + ["".join(rng.choice("GTGTGA") for _ in range(rng.randrange(200))) for _ in range(20)] + ["".join(rng.choice("ACGT") for _ in range(3000))]


@pytest.mark.parametrize("tile", [16, 17, 100, 1 << 20])
def test_as_a_plain_scan(spark, tile):
    rows = list(enumerate(texts()))
    found = motifs.hits(spark.createDataFrame(rows, "chrom long, seq string"), NAMES, tile=tile).collect()
    want = sorted((i, m, s) for i, t in rows for m in NAMES for s in plain(t or "", m))
    assert sorted((r.chrom, r.motif, r.start0) for r in found) == want


def test_empty_and_wrong_motifs(spark):
    assert motifs.hits(spark.createDataFrame([], "chrom string, seq string"), ["GTG"]).collect() == []
    assert motifs.hits(spark.createDataFrame([("c", "ATG")], "chrom string, seq string"), ["ATG"]).first().start0 == 0
    for bad in ([""], ["A", "A"]):
        with pytest.raises(ValueError):
            motifs.Automaton(bad)


def test_a_long_contig_is_many_tasks(spark):
    """All GT, the worst case: hits overlap from end to end, and the count is that from the left."""
    n = 1_000_000
    contig = spark.createDataFrame([("c",)], "chrom string").select("chrom", F.repeat(F.lit("GT"), n // 2).alias("seq"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    dealt = motifs.tiles(contig, "chrom", "seq", 2, 1 << 14).repartition("contig", "tile").select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(dealt) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(r["count"] for r in dealt) < 40
    got = motifs.hits(contig, ["GTG"], tile=1 << 14).agg(F.count(F.lit(1)), F.min("start0"), F.max("start0"), F.count_if(F.col("start0") % 4 != 0)).first()
    assert tuple(got) == (len(range(0, n - 2, 4)), 0, range(0, n - 2, 4)[-1], 0)
