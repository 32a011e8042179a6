"""BAM ranges: every way to cut a file gives the same rows, cut-off files raise, filters reach the source."""
import random
import struct
import zlib

import pytest

from lociq.sources import bam

def block(data):
    d = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = d.compress(data) + d.flush()
    return b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + struct.pack("<H", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def record(name, flag, ref, pos, length):
    ops = struct.pack("<I", length << 4) if length else b""
    body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 30, 0, bool(length), flag, length, -1, -1, 0) + name.encode() + b"\0" + ops + random.Random(name).randbytes((length + 1) // 2 + length) + b"NHC" + bytes([1 + flag % 3])
    return struct.pack("<i", len(body)) + body


def made(n=400, sizes=(1, 4000), longest=300, chroms=30):
    """A BAM file's bytes, in blocks that cut records anywhere, and its records' names."""
    rng = random.Random(n)
    raw = b"BAM\x01" + struct.pack("<i", 5) + b"@HD\tx" + struct.pack("<i", chroms)
    for c in range(chroms):
        raw += struct.pack("<i", 5) + f"c{c:03d}".encode() + b"\0" + struct.pack("<i", 100000)
    names = []
    for i in range(n):
        there = rng.random() < 0.9
        names.append(f"read{i}")
        raw += record(names[-1], 0 if there else 4, rng.randrange(chroms) if there else -1, rng.randrange(90000) if there else -1, rng.randrange(longest))
    out, at = b"", 0
    while at < len(raw):
        size = rng.randrange(*sizes)
        out += block(raw[at : at + size])
        if rng.random() < 0.1:
            out += block(b"")  # empty blocks may stand anywhere
        at += size
    return out + bam.CLOSING, names


def load(spark, path, **options):
    spark.dataSource.register(bam.BamSource)
    r = spark.read.format("bam")
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(str(path))


@pytest.mark.parametrize("longest,sizes", [(300, (1, 4000)), (9000, (100, 65000)), (20, (1, 60))])
def test_any_split_gives_the_same_rows(spark, tmp_path, longest, sizes):
    data, names = made(300 if longest < 1000 else 120, sizes, longest)
    (tmp_path / "a.bam").write_bytes(data)
    want = sorted(map(tuple, load(spark, tmp_path / "a.bam").collect()))
    assert sorted(r[0] for r in want) == sorted(names)
    for parts in (3, 50):
        df = load(spark, tmp_path / "a.bam", split_bytes=-(-len(data) // parts))
        assert df.rdd.getNumPartitions() >= parts - 1
        assert sorted(map(tuple, df.collect())) == want


def test_a_cut_off_file_raises(spark, tmp_path):
    data, _ = made(100)
    ends, at = [], 0
    while at < len(data):
        n = bam.block_length(data, at)
        at += n
        if n > len(bam.CLOSING):  # a cut behind an empty block can't be seen
            ends.append(at)
    for k, cut in enumerate((ends[-1], ends[len(ends) // 2], len(data) - 3, ends[3] + 7)):
        (tmp_path / f"{k}.bam").write_bytes(data[:cut])
        for split in (1 << 26, 2000):
            with pytest.raises(Exception, match="BAM file"):
                load(spark, tmp_path / f"{k}.bam", split_bytes=split).collect()


def test_filters_reach_the_source(spark, tmp_path):
    data, _ = made(200)
    (tmp_path / "a.bam").write_bytes(data)
    every = load(spark, tmp_path / "a.bam").collect()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = load(spark, tmp_path / "a.bam", push_filters="true", split_bytes=5000)
        got = df.where("chrom in ('c001', 'c002') and flag = 0 and start0 > 100")
        assert sorted(map(tuple, got.collect())) == sorted(tuple(r) for r in every if r.chrom in ("c001", "c002") and r.flag == 0 and r.start0 > 100)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "= 0" not in plan.split("Filter")[1].split("\n")[0] and df.where("flag = 4 and chrom = 'c001'").count() == 0
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_empty(spark, tmp_path):
    (tmp_path / "a.bam").write_bytes(made(0)[0])
    assert load(spark, tmp_path / "a.bam", split_bytes=40).collect() == []
    (tmp_path / "none").mkdir()
    assert load(spark, tmp_path / "none").collect() == []
