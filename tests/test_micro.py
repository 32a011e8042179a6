"""Hand-computed cases of the interval engine."""
import math
import random

import pytest
from pyspark.sql import functions as F

from lociq import config
from lociq.functions import attributes, coords, sequence
from lociq.operators import annotation, counting, coverage, expression, intervals, metagene, predictions

READS = [("r1", "+", 10, 30, 1, 0), ("r2", "+", 12, 28, 1, 0), ("r3", "-", 20, 30, 1, 16), ("r4", "-", 20, 25, 2, 16), ("r5", "+", 5, 22, 1, 0)]


@pytest.fixture(scope="module")
def reads(spark):
    rows = [("L", "c", s, a, a + n, a + n - 1, n, nh, flag, 1) for _, s, a, n, nh, flag in READS] + [("L", None, "+", None, None, None, 20, 0, 4, 1)]
    return spark.createDataFrame(rows, "library string, chrom string, strand string, start0 long, end0 long, stop0 long, read_length long, nh long, flag int, n long")


@pytest.fixture(scope="module")
def gene(spark):
    return spark.createDataFrame([("g1", "CDS", "c", "+", 10, 39)], "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")


def test_totals_and_accepted(reads):
    t = counting.totals(reads).first()
    assert (t.n, t.avg_len) == (5, 27.0)
    assert reads.where(counting.accepted()).count() == 4


@pytest.mark.parametrize("style, n", [("global", 3), ("fiveprime", 2), ("threeprime", 3), ("centered", 3)])
def test_styles(reads, gene, style, n):
    assert counting.count_by_style(reads, gene, style).first().cnt == n


def test_tracks(reads):
    def got(style):
        return {(r.strand, r.pos): r.value for r in coverage.track(reads.where("flag <> 4"), style).collect()}

    assert got("fiveprime") == {("+", 5): 1, ("+", 10): 1, ("+", 12): 1, ("-", 49): -1, ("-", 44): -0.5}
    assert got("threeprime") == {("+", 26): 1, ("+", 39): 2, ("-", 20): -1.5}
    c = got("centered")
    assert math.isclose(c["+", 21], 1 / 8) and math.isclose(c["+", 23], 1 / 8 + 1 / 6) and math.isclose(c["-", 31], -1 / 8 - 1 / 6) and math.isclose(c["-", 38], -1 / 8) and ("+", 29) not in c
    one = coverage.track(reads.where("nh = 1"), "global").groupBy("strand").agg(F.sum("value").alias("v"))
    assert {r.strand: r.v for r in one.collect()} == {"+": 80, "-": -30}


def test_a_sites(reads):
    def got(mirrored):
        return {(r.strand, r.pos): r.cnt for r in coverage.a_sites(reads, mirrored).collect()}

    assert got(True) == {("+", 29): 2, ("+", 16): 1, ("-", 30): 2}
    assert got(False)[("-", 2)] == 1 and got(False)[("-", 7)] == 1


def test_metagene(reads, gene):
    start = {(r.coord, r.read_length): r.cnt for r in metagene.profile(reads, gene, "start", "fiveprime", 5, 10).collect()}
    assert start == {(-5, 22): 1, (0, 30): 1, (2, 28): 1}
    assert {(r.coord, r.cnt) for r in metagene.profile(reads, gene, "stop", "threeprime", 5, 10).collect()} == {(-1, 1)}
    assert {r.coord for r in metagene.profile(reads, gene, "stop", "threeprime", 5, 10, mirrored_stop=True).collect()} == {-5}


def test_rpkm_and_ratios(spark):
    x = spark.range(1).select(counting.rpkm(F.lit(3), F.lit(4), F.lit(30)).alias("a"), expression.efficiency(F.lit(10.0), F.lit(5.0)).alias("b"), expression.efficiency(F.lit(10.0), F.lit(0.0)).alias("c")).first()
    assert (x.a, x.b, x.c) == (25_000_000.0, 2.0, None)


def test_counting_weights(spark):
    read = spark.createDataFrame([("L", "c", "+", 0, 9, 10, 2, 0, 1)], "library string, chrom string, strand string, start0 long, stop0 long, read_length long, nh long, flag int, n long")
    f = spark.createDataFrame([(f"f{i}", "CDS", "c", "+", i, i + 5) for i in range(3)], "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")
    assert counting.count_all_overlaps(read, f).count() == 0
    assert [r.cnt for r in counting.count_all_overlaps(read, f, multi=True, fraction=True).collect()] == [pytest.approx(1 / 6)] * 3
    once = read.withColumn("nh", F.lit(1))
    assert [r.cnt for r in counting.count_all_overlaps(once, f).collect()] == [1, 1, 1]
    assert [r.cnt for r in counting.count_all_overlaps(once, f, fraction=True).collect()] == [pytest.approx(1 / 3)] * 3
    assert counting.count_single_hits(once, f).count() == 0


def test_binned_join_equals_plain(spark):
    rng = random.Random(1)
    a = [(f"c{rng.randrange(2)}", s, s + rng.randrange(60)) for s in (rng.randrange(6000) for _ in range(300))] + [(None, 1, 5), ("c0", None, None)]
    b = [(f"c{rng.randrange(2)}", s, s + rng.choice([5, 300, 5000, 200000, 5000000])) for s in (rng.randrange(6000) for _ in range(80))]
    left, right = spark.createDataFrame(a, "chrom string, s long, e long"), spark.createDataFrame(b, "chrom string, x long, y long")
    plain = sorted((p[0], p[1], p[2], q[1], q[2]) for p in a for q in b if p[0] and p[0] == q[0] and p[1] is not None and p[1] <= q[2] and p[2] >= q[1])
    got = sorted((r.chrom, r.s, r.e, r.x, r.y) for r in intervals.overlap_join(left, right, ["chrom"], ("s", "e"), ("x", "y")).collect())
    assert got == plain
    kept = intervals.overlap_join(left, right.where("y - x < 10"), ["chrom"], ("s", "e"), ("x", "y"), how="left_anti").count()
    assert kept == sum(not any(p[0] and p[1] is not None and p[0] == q[0] and q[2] - q[1] < 10 and p[1] <= q[2] and p[2] >= q[1] for q in b) for p in a)


def seq(spark, text, column):
    return spark.createDataFrame([(text,)], "seq string").select(column.alias("x")).first().x


def test_sequences(spark):
    s = "ACGTATGGTGTGATTGAAGG"
    assert seq(spark, s, sequence.reverse_complement(F.col("seq"))) == "CCTTCAATCACACCATACGT"
    assert seq(spark, "ATGGTGTGATAA", sequence.translated(F.col("seq"))) == "MV"
    assert seq(spark, "ATGGT", sequence.translated(F.col("seq"))) == "" and seq(spark, "ATGNNN", sequence.translated(F.col("seq"))) == "MX"


@pytest.mark.parametrize("text, want", [("ID=a;Name=x;", {"id": "a", "name": "x"}), ("ID=a;id=b", {"id": "a"}), ("ID=a;;Name=x", {"id": "a", "name": "x"}), ("ID=a;Name", None)])
def test_attributes(spark, text, want):
    assert seq(spark, text, attributes.gff3("seq")) == want
    assert seq(spark, text, attributes.malformed("seq")) == (want is None)


def test_gtf_attributes(spark):
    assert seq(spark, 'gene_id "g1"; gene_name "abc"; empty "";', attributes.gtf("seq")) == {"gene_id": "g1", "gene_name": "abc"}


def test_lengths():
    assert coords.lengths("22,23,27,35-34") == [22, 23, 27, 34, 35]
    with pytest.raises(ValueError):
        coords.lengths("1-2-3")


def test_roots(spark):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "gone"), ("e", "c"), ("f", "e")], "id string, parent string")
    want = {"a": ("a", 0), "b": ("a", 1), "c": ("a", 2), "d": ("d", 0), "e": ("a", 3), "f": ("a", 4)}
    assert {r.id: (r.root, r.depth) for r in annotation.roots(df).collect()} == want
    assert {r.id: (r.root, r.depth) for r in annotation.roots_within(df, 5).collect()} == want


def test_ranks(spark):
    rows = [("c", 1, 2, "+", 5.0, -1), ("c", 2, 3, "+", 3.0, 0), ("c", 3, 4, "+", 2.0, -1)]
    got = predictions.ranked(spark.createDataFrame(rows, "chrom string, start1 long, stop1 long, strand string, pred double, dist int")).orderBy("pred_rank").collect()
    assert [(r.pred_rank, r.novel_rank) for r in got] == [(1, 1), (2, None), (3, 2)]


def test_directions(spark):
    rows = [(1.0, 0.05), (-1.0, 0.05), (0.99, 0.01), (2.0, None), (2.0, float("nan"))]
    got = spark.createDataFrame(rows, "f double, p double").select(expression.direction("f", "p", 1.0, 0.05).alias("d")).collect()
    assert [r.d for r in got] == ["up", "down", "none", "none", "none"]


def test_natural_order_and_ratio_columns(spark):
    names = ["chr10", "chr2", "chr02a", "X", "2L", "chr2a", "10", "9"]
    got = [r.c for r in spark.createDataFrame([(n,) for n in names], "c string").orderBy(coords.natural("c")).collect()]
    assert got == ["2L", "9", "10", "X", "chr2", "chr02a", "chr2a", "chr10"]
    assert expression.ratio_columns([("TE", "A", "1"), ("TE", "A", "2"), ("TE", "B", "1")]) == ["TE-A-1", "TE-A-2", "TE-A-avg", "TE-B-1"]


def test_genes_stay_in_bounds(spark):
    genes = spark.createDataFrame([("a", "c", "+", 5, 90), ("b", "c", "-", 20, 79), ("d", "c", "-", 20, 80), ("e", "gone", "+", 50, 60)], "id string, chrom string, strand string, f_start0 long, f_stop0 long")
    lengths = spark.createDataFrame([("c", 100)], "chrom string, length long")
    assert {r.id for r in metagene.in_bounds(genes, lengths, 20).collect()} == {"b"}


def test_placed_results_raise_without_a_place(spark):
    results, a = spark.createDataFrame([("f1",), ("c:3-9:-",)], "id string"), spark.createDataFrame([("f1", "c", 1, 2, "+")], "id string, chrom string, start1 long, stop1 long, strand string")
    assert {(r.id, r.start1) for r in expression.placed(results, a).collect()} == {("f1", 1), ("c:3-9:-", 3)}
    with pytest.raises(Exception, match="neither annotated"):
        expression.placed(results.union(spark.createDataFrame([("what",)], "id string")), a).collect()


def test_settings(spark):
    assert config.Settings().problems(["a", "b"]) == []
    bad = config.Settings(filtering=["x"], padj_cutoff=2, read_lengths="a", contrasts=["a-z"], differential_expression=True, workflow="no")
    assert len(bad.problems(["a"])) == 6
    sheet = spark.createDataFrame([("RIBO", "A", "1", "f", None), ("X", "a b", "0", " ", None), ("RIBO", "A", "1", "f", None)], "method string, condition string, replicate string, fastqFile string, fastqFile2 string")
    assert sorted(r.problem for r in config.sample_problems(sheet).collect()) == sorted(["unknown method", "condition isn't of letters and digits", "replicate isn't a whole number from 1", "no file", "sample is there twice"])


def test_counts_of_equal_reads_as_rows(spark):
    """Equal reads as rows of their own count as the collapsed ones do."""
    schema = "library string, chrom string, strand string, start0 long, stop0 long, read_length long, nh int, flag int, n long"
    reads = spark.createDataFrame([("L", "c", "+", 5, 9, 5, 2, 0, 1)] * 2 + [("L", "c", "+", 5, 30, 26, 1, 0, 1)] * 3, schema)
    genes = spark.createDataFrame([("g", "CDS", "c", "+", 0, 20), ("h", "CDS", "c", "+", 25, 40)], "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")
    for r in (reads, counting.collapsed(reads)):
        got = {(x.id, x.cnt) for x in counting.count_all_overlaps(r, genes, multi=True, fraction=True).collect()}
        assert got == {("g", 2 / 2 + 3 / 2), ("h", 3 / 2)}
        assert {(x.id, x.cnt) for x in counting.count_single_hits(r, genes).collect()} == {("g", 2.0)}


def test_repeated_ids_keep_rows(spark):
    rows = [("g", None, {"locus_tag": "T"}), ("m", "g", {}), ("m", "g", {}), ("c", "m", {}), ("c", "m", {}), ("c", "m", {"locus_tag": "own"}), (None, "m", {})]
    df = spark.createDataFrame(rows, "id string, parent string, attrs map<string, string>")
    root = annotation.roots(df)
    assert {tuple(r) for r in root.collect()} == {("g", "g", 0), ("m", "g", 1), ("c", "g", 2)} == {tuple(r) for r in annotation.roots_within(df, 3).collect()}
    got = sorted(((r.id, r.root, r.locus_tag) for r in annotation.enriched(df, root).collect()), key=str)
    assert got == sorted([("g", "g", "T"), ("m", "g", "T"), ("m", "g", "T"), ("c", "g", "T"), ("c", "g", "T"), ("c", "g", "own"), (None, None, None)], key=str)


def test_outside_a_mask(spark):
    """Short, long, null and reversed reads against every feature, with nested and touching ones."""
    rng = random.Random(8)
    reads = [(f"c{rng.randrange(3)}", s, s + rng.choice([0, 20, 300, 4095, 4096, 4097, 20000, -5]), i) for i, s in enumerate(rng.randrange(60000) for _ in range(500))] + [(None, 1, 5, 900), ("c0", None, 5, 901), ("c0", 5, None, 902)]
    mask = [(f"c{rng.randrange(2)}", s, s + rng.choice([0, 10, 700, 9000])) for s in (rng.randrange(60000) for _ in range(12))] + [("c0", 100, 200), ("c0", 120, 130), ("c0", 201, 250), (None, 0, 9), ("c1", 5, 3)]
    got = counting.outside(spark.createDataFrame(reads, "chrom string, start0 long, stop0 long, i int"), spark.createDataFrame(mask, "chrom string, f_start0 long, f_stop0 long"))
    hit = lambda r: any(r[0] is not None and r[0] == m[0] and r[1] is not None and r[2] is not None and r[1] <= r[2] and m[1] <= m[2] and r[1] <= m[2] and r[2] >= m[1] for m in mask)
    assert sorted(r.i for r in got.collect()) == [r[3] for r in reads if not hit(r)] and got.columns == ["chrom", "start0", "stop0", "i"]


@pytest.mark.parametrize("tasks", [None, 3])
@pytest.mark.parametrize("style", ["global", "centered"])
def test_coverage_in_tiles(spark, style, tasks):
    """Runs, their bins and expanded positions against direct sums, over tile borders, with equal reads in several parts of the input; two shuffles make the bins."""
    rng, tile = random.Random(3), coverage.TILE
    rows = [("L", "c", rng.choice("+-"), s, s + rng.choice([1, 22, 23, 60, 150, 2 * tile + 7]), rng.choice([1, 2, 3]), 1) for s in (rng.choice([0, tile - 30, 3 * tile - 1]) + rng.randrange(60) for _ in range(60))]
    rows += [("L", "c", "+", tile - 25, tile + 25, 1, 2)] * 40 + [("L", "c", "+", 9, 9, 1, 1), ("L", "c", "+", 9, 4, 1, 1)]
    reads = spark.createDataFrame(rows, "library string, chrom string, strand string, start0 long, end0 long, nh long, n long").repartition(5)
    cut, value, bins = 0 if style == "global" else 11, {}, {}
    for _, _, strand, a, e, nh, n in rows:
        for p in range(a + cut, e - cut):
            value[strand, p] = value.get((strand, p), 0) + (1 if strand == "+" else -1) * n / nh / (1 if style == "global" else e - a - 22)
    for (strand, p), v in value.items():
        bins.setdefault((strand, p // 100), []).append(v)
    near = lambda x, y: abs(x - y) < 1e-9
    got = {(r.strand, r.pos): r.value for r in coverage.track(reads, style, tasks=tasks).collect()}
    assert got.keys() == value.keys() and all(near(got[k], value[k]) for k in value)
    found = coverage.runs(reads, style, tasks=tasks)
    assert all(r.tile * tile <= r.start0 <= r.stop0 < (r.tile + 1) * tile for r in found.collect())
    out = coverage.binned(found, 100)
    got = {(r.strand, r.bin): r for r in out.collect()}
    assert got.keys() == bins.keys() and all(got[k].positions == len(x) and near(got[k].total, sum(x)) and near(got[k].peak, max(map(abs, x))) for k, x in bins.items())
    if tasks:
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert plan.count("Exchange hashpartitioning") == 2 and f", {tasks}), REPARTITION_BY_NUM" in plan
    with pytest.raises(ValueError):
        coverage.binned(found, 7)


def test_attributes_are_parsed_once(spark):
    """An attribute list is split once, not once a field and key, so long ones cost little; of equal keys the first counts."""
    long = "".join(f"K{i % 900}={i};" for i in range(1000))
    df = spark.createDataFrame([(long,), ("a=1;b",), (None,), ("",)], "x string").select("x", attributes.gff3("x").alias("m"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    got = {r.x: r.m for r in df.collect()}
    assert got[long] == {f"k{i}": str(i) for i in range(900)} and got["a=1;b"] is None and got[None] is None and got[""] == {}
