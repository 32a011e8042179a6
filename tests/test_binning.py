"""Bins and the region index against full scans, and what a region reads."""
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lociq.operators import binning
from lociq.plans import views
from lociq.sources import readers, sinks


def test_bins(spark):
    rng = random.Random(1)
    spans = [(a, a + rng.choice([0, 5, 20000, 10**6, 10**9])) for a in (rng.randrange(2**31) for _ in range(500))] + [(2**32 - 1, 2**32 - 1), (2**33, 2**33), (0, 2**40), (2**14 - 1, 2**14), (None, 3)]
    got = [r[0] for r in spark.createDataFrame(spans, "a long, b long").coalesce(1).select(binning.bin_of(F.col("a"), F.col("b"))).collect()]
    for (a, b), x in zip(spans, got):
        if a is None:
            assert x is None
            continue
        level = next((k for k in range(binning.LEVELS, 0, -1) if a >> binning.shift_of(k) == b >> binning.shift_of(k) < 8**k), 0)
        assert x == (binning.first_bin(level) + (a >> binning.shift_of(level)) if level else 0)
        for c, d in ((a, a), (b, b), (max(0, a - 100), a + 7)):
            assert any(lo <= x <= hi for lo, hi in binning.bins_of_region(c, d))


@pytest.mark.parametrize("region", [(500000, 500100), (0, 0), (16383, 16384), (299000, 1200000), (2000000, 3000000)])
def test_region_index(spark, tmp_path_factory, region):
    path = made(spark, tmp_path_factory)
    table = spark.read.parquet(path)
    found = readers.in_region(table, "c1", *region)
    want = table.where((F.col("chrom") == "c1") & (F.col("start0") <= region[1]) & (F.col("end0") > region[0]))
    assert sorted(r.read_id for r in found.collect()) == sorted(r.read_id for r in want.collect())
    # Only c1's files, and of their row groups those that hold one of the region's bins.
    files = glob.glob(f"{path}/chrom=c1/*.parquet")
    bins, groups, hit = binning.bins_of_region(*region), 0, 0
    for f in files:
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("region_bin")
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups += 1
            hit += any(s.min <= hi and s.max >= lo for lo, hi in bins)
    plan = found._jdf.queryExecution().executedPlan()
    found.collect()
    scan = str(plan.toString())
    assert "PartitionFilters: [isnotnull(chrom" in scan and "region_bin" in scan.split("PushedFilters")[1]
    assert groups >= 12 and (hit <= groups // 2 or region[1] - region[0] > 10**5)
    read = found.select("read_id", F.col("_metadata.file_path").alias("f")).agg(F.count_distinct("f")).first()[0]
    assert read <= hit


def made(spark, tmp_path_factory, made_once={}):
    if "path" not in made_once:
        made_once["path"] = str(tmp_path_factory.mktemp("reads") / "t")
        x = spark.range(40000).select("id", F.concat(F.lit("r"), "id").alias("read_id"), F.when(F.col("id") % 4 == 0, "c2").otherwise("c1").alias("chrom"), (F.pmod(F.xxhash64("id"), F.lit(3000000))).alias("start0"))
        # One alignment in a thousand spans much of the contig.
        x = x.withColumn("end0", F.col("start0") + F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) == 0, 2500000).otherwise(50)).withColumn("stop0", F.col("end0") - 1)
        sinks.alignments(x.drop("id"), made_once["path"], rows=2000)
    return made_once["path"]


def test_layout_of_the_tables(spark, tmp_path):
    """The reads of the tables, written and read by region, are those of a full scan."""
    reads = views.reads(spark, "/root/testdata/sf0.001").withColumn("end0", F.col("stop0") + 1)
    sinks.alignments(reads, str(tmp_path / "x"))
    got = readers.in_region(spark.read.parquet(str(tmp_path / "x")), "chr1", 700, 1200)
    want = reads.where("chrom = 'chr1' and start0 <= 1200 and end0 > 700")
    assert got.count() == want.count() > 0
