"""Readers and writers of result tables, the settings file, and small table operators."""
import copy
import glob

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociq import config
from lociq.operators import annotation, expression
from lociq.plans import queries
from lociq.sources import readers, schemas, sinks

SETTINGS = """
biologySettings: {adapterS3: "", adapterS5: "", adapterP3R1: "", adapterP5R1: "", adapterP3R2: "", adapterP5R2: "", genome: g.fa, annotation: a.gff, samples: s.tsv, alternativeStartCodons: [GTG, TTG]}
differentialExpressionSettings: {differentialExpression: "on", features: [CDS], contrasts: [A-B], padjCutoff: 0.05, log2fcCutoff: 1.5}
predictionSettings: {deepribo: "off"}
readstatSettings: {readLengths: "20-30"}
metageneSettings: {positionsOutsideORF: 10, positionsInORF: 20, filteringMethods: [Overlap], neighboringGenesDistance: 5, rpkmThreshold: 2.0, lengthCutoff: 30, mappingMethods: [global], readLengths: "25,27-29", normalizationMethods: [raw], outputFormats: [svg], includePlotlyJS: local, colorList: []}
workflowSettings: {workflow: full}
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_settings_file(tmp_path):
    pytest.importorskip("yaml")
    held = config.read_file(write(tmp_path / "c.yaml", SETTINGS))
    assert config.file_problems(held, ["A", "B"], lambda p: True) == []
    s = config.loaded(held)
    assert (s.differential_expression, s.contrasts, s.log2fc_cutoff, s.read_lengths, s.metagene_lengths, s.filtering, s.positions_inside, s.workflow) == (True, ["A-B"], 1.5, "20-30", "25,27-29", ["overlap"], 20, "full")
    assert config.loaded({}) == config.Settings()
    bad = [
        ("biologySettings", "alternativeStartCodons", ["GTX"]), ("biologySettings", "adapterS3", 5), ("differentialExpressionSettings", "padjCutoff", 1.0), ("differentialExpressionSettings", "padjCutoff", 1), ("differentialExpressionSettings", "features", []),
        ("differentialExpressionSettings", "contrasts", ["A"]), ("differentialExpressionSettings", "contrasts", ["A-Z"]), ("predictionSettings", "deepribo", "maybe"), ("readstatSettings", "readLengths", ""), ("metageneSettings", "positionsInORF", -1), ("metageneSettings", "positionsInORF", True),
        ("metageneSettings", "mappingMethods", ["x"]), ("metageneSettings", "normalizationMethods", [3]), ("metageneSettings", "outputFormats", "svg"), ("metageneSettings", "includePlotlyJS", "no"), ("workflowSettings", "workflow", "none"), ("metageneSettings", "readLengths", "1-2-3"),
    ]
    for section, key, value in bad:
        now = copy.deepcopy(held)
        now[section][key] = value
        assert len(config.file_problems(now, ["A", "B"])) == 1 and key in config.file_problems(now, ["A", "B"])[0], (section, key, value)
    for section in config.KEYS:
        for key in config.KEYS[section]:
            now = copy.deepcopy(held)
            del now[section][key]
            assert config.file_problems(now, ["A", "B"]) == [f"{section}.{key}: missing"]
        now = copy.deepcopy(held)
        del now[section]
        assert config.file_problems(now) == [f"{section}: missing"]
    assert len(config.file_problems(held, exists=lambda p: p != "a.gff")) == 1


def test_result_tables(spark, tmp_path):
    assert [tuple(r) for r in readers.totals(spark, write(tmp_path / "t.tsv", "RIBO-A-1\tc1\t12\n")).collect()] == [("RIBO-A-1", "c1", 12)]
    head = "\t".join(c.split()[0] for c in schemas.PREDICTIONS_A.split(", "))
    a = readers.predictions_a(spark, write(tmp_path / "a.tsv", head + "\nc:1-9\t+\t9\tATG\t5\t1.5\t0.5\t1\t2\t0.9\tnew\tref\t3\n")).first()
    assert (a.ORF_locus, a.length, a.ribo_rpkm, a.prob) == ("c:1-9", 9, 1.5, 0.9)
    names = [c.split()[0] for c in schemas.PREDICTIONS_B.split(", ")]
    row = {n: "" for n in names} | {"locus": "c:1-9", "pred": "0.5", "SS_pred_rank": "7", "label": "True"}
    lines = [",".join(names)] + [",".join(str((row | x)[n]) for n in names) for x in ({}, {"SS_pred_rank": 999999}, {"pred": ""})]
    b = readers.predictions_b(spark, write(tmp_path / "b.csv", "\n".join(lines) + "\n")).collect()
    assert [(r.locus, r.pred, r.SS_pred_rank, r.label) for r in b] == [("c:1-9", 0.5, 7, True)]
    de = readers.de_table(spark, write(tmp_path / "r.csv", "id,baseMean,log2FoldChange,lfcSE,stat,pvalue,padj\ng,1.5,-2,0.1,3,0.01,NA\n"), schemas.DE_RIBOREX).first()
    assert (de.id, de.log2FoldChange, de.padj) == ("g", -2.0, None)
    te = readers.de_table(spark, write(tmp_path / "d.tsv", "baseMean\tlog2FoldChange\tlfcSE\tpvalue\tpadj\ng\t1\t2\t3\t0.5\tNA\n"), schemas.DE_DELTATE, index_header=True).collect()
    assert [(r[0], r.baseMean, r.padj) for r in te] == [("g", 1.0, None)]
    assert readers.de_table(spark, write(tmp_path / "e.tsv", ""), schemas.DE_DELTATE, index_header=True).collect() == []


def lines(path):
    return [x for f in sorted(glob.glob(f"{path}/part-*")) for x in open(f).read().splitlines()]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("x", 1, None), ("y\"", 2, "b")], "a string, n int, s string")
    sinks.tsv(df.coalesce(1), str(tmp_path / "t"))
    assert lines(tmp_path / "t") == ["a\tn\ts", "x\t1\t", "y\"\t2\tb"]
    tracks = spark.createDataFrame([("L1", "c2", "+", p, 1.5) for p in (0, 2500)] + [("L1", "c1", "+", p, 2.0) for p in range(0, 3000, 500)] + [("L1", "c1", "-", 5, -1.0), ("L2", "c1", "+", 7, 1.0)], "library string, chrom string, strand string, pos long, value double")
    sinks.wiggle(tracks, str(tmp_path / "w"))
    got = lines(tmp_path / "w" / "library=L1" / "strand=+")
    assert got[0] == 'track type=wiggle_0 name="L1 +"' and sum(x.startswith("track") for x in got) == 1
    assert [x for x in got if x.startswith("variableStep")] == ["variableStep chrom=c1 span=1"] * 3 + ["variableStep chrom=c2 span=1"] * 2 and [x for x in got if x[0].isdigit()] == [f"{p + 1} 2.0" for p in range(0, 3000, 500)] + ["1 1.5", "2501 1.5"]
    assert lines(tmp_path / "w" / "library=L2" / "strand=+")[0] == 'track type=wiggle_0 name="L2 +"'
    genes = spark.createDataFrame([("g2", "CDS", "c1", "+", 10, 20), ("g1", "rRNA", "c1", "-", 0, 5), ("g0", "gene", "c1", "+", 0, 99)], "id string, feature string, chrom string, strand string, f_start0 long, f_stop0 long")
    sinks.bed6(genes, str(tmp_path / "b"))
    assert lines(tmp_path / "b") == ["c1\t0\t6\tg1\t0\t-", "c1\t10\t21\tg2\t0\t+"]
    back = readers.bed(spark, str(tmp_path / "b")).collect()
    assert sorted((r.name, r.start0, r.stop0) for r in back) == [("g1", 0, 5), ("g2", 10, 20)]
    x = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "sheet string, v int")
    sinks.sheets(x, str(tmp_path / "s"))
    assert sorted(r.v for r in readers.sheet(spark, str(tmp_path / "s"), "a").collect()) == [1, 2]
    counts = spark.createDataFrame([("g", "A-1", 2.0), ("g", "B-1", 1.0), ("h", "A-1", 5.0)], "id string, library string, cnt double")
    sinks.count_matrix(counts.coalesce(1), str(tmp_path / "m"), ["A-1", "B-1"])
    assert sorted({x for x in lines(tmp_path / "m")}) == ["g,2.0,1.0", "h,5.0,0.0", "id,A_1,B_1"]


def test_small_operators(spark):
    path = spark.createDataFrame([("a/b/A-B_riborex_sorted.csv",), ("A-B.csv",), ("",), (None,), ("x/",)], "p string")
    assert [None if r.x is None else (r.x.contrast, r.x.tool) for r in path.select(expression.of_result_file(F.col("p")).alias("x")).collect()][:2] == [("A-B", "riborex"), ("A-B", None)]
    assert [r.x for r in path.select(expression.file_name(F.col("p")).alias("x")).collect()] == ["A-B_riborex_sorted.csv", "A-B.csv", None, None, None]
    rows = [("g", None, 5), ("g", None, 9), ("c", "g", 1), (None, "g", 2), ("d", "no", 3)]
    got = annotation.with_parent(spark.createDataFrame(rows, "id string, parent string, v int"), ["v"]).collect()
    assert sorted((str(r.id), r.v, r.parent_v) for r in got) == [("None", 2, 5), ("c", 1, 5), ("d", 3, None), ("g", 5, None), ("g", 9, None)]
    a = spark.createDataFrame([("a", {"name": ""}), ("b", {"old_locus_tag": "x"}), ("c", None)], "id string, attrs map<string, string>")
    assert [r.id for r in annotation.annotated(a).collect()] == ["b"]


def test_components_against_numpy(spark):
    d = "/root/testdata/sf0.001"
    got = {r.library: r for r in queries.queries()["pca_scores"](spark, d).collect()}
    counts = queries._counts(spark, d).toPandas()
    wide = np.log1p(counts.pivot(index="library", columns="id", values="cnt"))
    top = sorted(wide.columns, key=lambda c: (-wide[c].var(ddof=1), c))[:500]
    x = wide[top].to_numpy()
    x = x - x.mean(axis=0)
    u, s, _ = np.linalg.svd(x, full_matrices=False)
    for i in range(3):
        want, have = u[:, i] * s[i], np.array([got[c][f"pc{i + 1}"] for c in wide.index])
        assert np.allclose(np.abs(want), np.abs(have), atol=1e-6) and np.isclose(got[wide.index[0]][f"share{i + 1}"], s[i] ** 2 / (s**2).sum())


def test_equal_values_tie_by_key(spark):
    """However the values of a key come together, equal sets have equal variances, so ties go by key."""
    import random

    from lociq.operators import expression

    rng, held = random.Random(8), [0, 0, 1, 1, 1, 2, 2, 2, 3, 6, 6, 8]
    rows = [(f"k{i:03}", float(v)) for i in range(200) for v in rng.sample(held, len(held))] + [("one", 5.0)]
    got = expression.most_variable(spark.createDataFrame(rows, "id string, v double").repartition(7), "id", "v", 50).collect()
    assert [r.id for r in got] == [f"k{i:03}" for i in range(50)] and len({r.variance for r in got}) == 1
