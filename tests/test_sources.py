"""Readers, writers and streaming on small files."""
import gzip
import struct

import pytest

from lociq.operators import intervals
from lociq.sources import readers, sinks
from lociq.sources.bam import BamSource
from lociq.streaming import totals


def write(path, text):
    path.write_text(text)
    return str(path)


def test_fasta_and_gff(spark, tmp_path):
    fa = readers.fasta(spark, write(tmp_path / "g.fa", ">c1 first\nACGT\nAC\n>c2\nGG\n"))
    assert sorted(map(tuple, fa.collect())) == [("c1", "ACGTAC"), ("c2", "GG")]
    gff = readers.gff(spark, write(tmp_path / "a.gff", "##gff-version 3\nc1\tx\tCDS\t2\t4\t.\t+\t0\tID=a#1;\n"))
    r = gff.first()
    assert gff.count() == 1 and (r.start0, r.stop0, r.attributes) == (1, 3, "ID=a#1;")
    more = readers.gff(spark, write(tmp_path / "b.gff", "##gff-version 3\nc1\tx\tCDS\t2\t4\t.\t+\t0\tID=a;\n##FASTA\n>c1 a\tb\tc\nACGT\nAC\n"))
    assert [r.attributes for r in more.collect()] == ["ID=a;"]
    sinks.gff3(gff.drop("start0", "stop0"), str(tmp_path / "out"))
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ["##gff-version 3", "c1\tx\tCDS\t2\t4\t.\t+\t0\tID=a#1;"]


SAM = "@HD\tVN:1.6\nr1\t0\tc1\t5\t60\t3M1D2M\t*\t0\t0\tACGTA\tIIIII\tNH:i:2\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\nr3\t16\tc1\t1\t9\t4M\t*\t0\t0\tACGT\tIIII\tXX:Z:a\n"


def test_sam(spark, tmp_path):
    write(tmp_path / "RIBO-A-1.sam", SAM)
    got = {r.read_id: r for r in readers.alignments_of(spark, str(tmp_path)).collect()}
    assert (got["r1"].start0, got["r1"].end0, got["r1"].stop0, got["r1"].nh, got["r1"].library) == (4, 10, 8, 2, "RIBO-A-1")
    assert got["r2"].start0 is None and got["r3"].strand == "-" and got["r3"].nh == 1


def test_bam(spark, tmp_path):
    def record(name, flag, ref, pos, mapq, cigar, length, tags):
        ops = b"".join(struct.pack("<I", n << 4 | "MIDNSHP=X".index(o)) for n, o in cigar)
        body = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, mapq, 0, len(cigar), flag, length, -1, -1, 0) + name.encode() + b"\0" + ops + bytes((length + 1) // 2 + length) + tags
        return struct.pack("<i", len(body)) + body

    head = b"BAM\x01" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 3) + b"c1\0" + struct.pack("<i", 1000)
    rows = record("r1", 0, 0, 4, 60, [(3, "M"), (1, "D"), (2, "M")], 5, b"XSZab\0NHC\x02") + record("r2", 4, -1, -1, 0, [], 2, b"") + record("r3", 16, 0, 0, 9, [(4, "M")], 4, b"XBBs" + struct.pack("<i", 2) + bytes(4))
    raw = head + rows
    (tmp_path / "a.bam").write_bytes(gzip.compress(raw[:50]) + gzip.compress(raw[50:]) + gzip.compress(b""))
    spark.dataSource.register(BamSource)
    got = {r.read_id: r for r in spark.read.format("bam").load(str(tmp_path / "a.bam")).collect()}
    assert (got["r1"].chrom, got["r1"].start0, got["r1"].end0, got["r1"].stop0, got["r1"].nh) == ("c1", 4, 10, 8, 2)
    assert got["r2"].start0 is None and got["r2"].chrom is None and (got["r3"].strand, got["r3"].nh) == ("-", 1)
    write(tmp_path / "RIBO-A-1.sam", SAM)
    both = readers.alignments_of(spark, str(tmp_path))
    assert sorted((r.library, r.read_id) for r in both.collect()) == [(x, f"r{i}") for x in ("RIBO-A-1", "a") for i in (1, 2, 3)]
    sinks.alignments(both.where("chrom is not null"), str(tmp_path / "reads"))
    near = readers.in_region(spark.read.parquet(str(tmp_path / "reads")), "c1", 4, 5)
    assert sorted((r.library, r.read_id) for r in near.collect()) == [("RIBO-A-1", "r1"), ("a", "r1")]


def test_feature_counts_and_samples(spark, tmp_path):
    p = write(tmp_path / "c.tsv", "# program\nGeneid\tChr\tStart\tEnd\tStrand\tLength\ta\tb\ng\tc;c\t1;5\t3;9\t+;+\t8\t2\t3\n")
    got = sorted(tuple(r) for r in readers.feature_counts(spark, p, ["a", "b"]).select("start", "library", "cnt").collect())
    assert got == [(1, "a", 2.0), (1, "b", 3.0), (5, "a", 2.0), (5, "b", 3.0)]
    s = readers.samples(spark, write(tmp_path / "s.tsv", "method\tcondition\treplicate\tfastqFile\tfastqFile2\n#no\tx\t1\tf\t\nRIBO\tA\t1\tfastq/a.gz\t\n"))
    assert [(r.method, r.fastqFile2) for r in s.collect()] == [("RIBO", None)]


def test_fastq(spark, tmp_path):
    got = readers.fastq(spark, write(tmp_path / "a.fq", "@r1 x\nACG\n+\nIII\n@r2\nAC\n+\nII\n")).collect()
    assert [(r.id, r.seq, r.quality) for r in got] == [("r1", "ACG", "III"), ("r2", "AC", "II")]


def test_fastq_quality_and_fasta_header_signs(spark, tmp_path):
    """A quality line may begin with @ or be nothing but @s; a header may hold >. Files are cut at every few bytes, and end in several ways."""
    reads = [("r1", "ACG", "III"), ("r2", "ACGT", "@III"), ("r3", "A", "@"), ("r4", "AC", "@@"), ("r5", "ACG", "@+@"), ("r6", "AC", "II")]
    text = "".join(f"@{i} about @{i}\n{s}\n+{i}\n{q}\n" for i, s, q in reads)
    for k, t in enumerate((text, text.rstrip("\n"), text.replace("\n", "\r\n"))):
        p = write(tmp_path / f"{k}.fq", t)
        for size in ("128m", "30"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = sorted(tuple(r) for r in readers.fastq(spark, p).collect())
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
            assert got == reads, (k, size)
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "a.fq.gz").write_bytes(gzip.compress(text.encode()))
    write(tmp_path / "z" / "b.fq", text)
    assert sorted(tuple(r) for r in readers.fastq(spark, str(tmp_path / "z")).collect()) == sorted(reads * 2)
    empty = "@r1\n\n+\n\n@r2 x\nAC\n+\nII\n@r3\n\n+r3\n\n"
    for k, t in enumerate((empty, empty[:-1], empty + "\n", empty.replace("\n", "\r\n"))):
        p = write(tmp_path / f"empty{k}.fq", t)
        assert sorted((r.id, r.seq, r.quality) for r in readers.fastq(spark, p).collect()) == [("r1", "", ""), ("r2", "AC", "II"), ("r3", "", "")], k
    for bad in ("@r\nACG\n+\nII\n", "@r\nACG\n+\n", "@r\nACG\nIII\n@s\nA\n+\nI\n"):
        with pytest.raises(Exception, match="four lines"):
            readers.fastq(spark, write(tmp_path / "bad.fq", bad)).collect()
    fa = readers.fasta(spark, write(tmp_path / "h.fa", ">c1 len>3 x\nAC\nGT\n>c2\r\nGG\r\n"))
    assert sorted(map(tuple, fa.collect())) == [("c1", "ACGT"), ("c2", "GG")]


def test_bedgraph_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("c", 0, 9, 1), ("c", 5, 14, 1)], "chrom string, s long, e long, w int")
    runs = intervals.runs_of_depth(df, ["chrom"], ("s", "e"), "w")
    sinks.bedgraph(runs, str(tmp_path / "b"))
    got = sorted(tuple(r) for r in readers.bedgraph(spark, str(tmp_path / "b")).collect())
    assert got == [("c", 0, 4, 1.0), ("c", 5, 9, 2.0), ("c", 10, 14, 1.0)]


@pytest.mark.parametrize("files", [1, 3])
def test_running_totals(spark, tmp_path, files):
    schema = "library string, chrom string, flag int, read_length long"
    for i in range(files):
        spark.createDataFrame([("L", "c", 0, 10), ("L", "c", 4, 10), ("L", f"c{i}", 16, 20)], schema).coalesce(1).write.parquet(str(tmp_path / "in"), mode="append")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = totals.running_totals(stream).writeStream.outputMode("complete").format("memory").queryName(f"totals{files}").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    got = {r.chrom: (r.n, r.sum_len) for r in spark.table(f"totals{files}").collect()}
    assert got == {"c": (files, 10 * files), **{f"c{i}": (1, 20) for i in range(files)}}
