"""Nulls, empty and long texts, ties, repeated rows, empty tables, and extra columns with clashing names, for every operator and stage."""
import pytest

import corpus_pipeline
from lociq.llm import bpe, decontam, exact_dedup, licenses, mixing, near, pii, quality, queries, secrets, simhash, toxicity

LONG = "The River of " * 20000 + "password = abcdefgh1234 " + "x" * 200000
ROWS = [(1, "One small text here"), (1, "One small text here"), (2, "one small  text here"), (3, None), (4, ""), (5, " \n"), (None, "no id"), (None, None), (6, LONG), (7, LONG), (8, "é\u0000  text"), (9, "One small text here")]
CLASH = ["row", "fp", "block", "t", "key", "n", "salt", "__id", "base", "spans", "score", "kind", "token"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *["clash"] * len(CLASH)) for i, t in ROWS], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH))
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 1), (3, None, None), (None, 1, 1), (4, 0, 0), (6, 1, 0)], "doc_id long, quality int, toxic int")
    benchmark = spark.createDataFrame([(1, "a text that is not in any of them at all"), (1, None), (None, ""), (2, "x" * 700)], "item_id long, text string")
    return docs, labels, benchmark


def run(name, docs, labels, benchmark):
    path, pattern = queries.tokenizer()
    return {
        "licenses": lambda: licenses.scan(docs), "secrets": lambda: queries.digest(secrets.find(docs), secrets.BASE), "pii": lambda: queries.digest(pii.find(docs), pii.BASE),
        "mixing": lambda: mixing.scores(docs), "toxicity": lambda: toxicity.score(docs, toxicity.fit(docs, labels)), "exact": lambda: exact_dedup.exact_duplicates(docs), "decontam": lambda: decontam.contaminated(docs, benchmark),
        "bpe": lambda: bpe.decode(bpe.encode(docs, path, pattern), path, pattern), "simhash": lambda: simhash.near_duplicates(docs), "quality": lambda: quality.score(docs, quality.fit(docs, labels)),
    }[name]().collect()


ALL = ["licenses", "secrets", "pii", "mixing", "toxicity", "exact", "decontam", "bpe", "simhash", "quality"]


@pytest.mark.parametrize("name", ALL)
def test_awkward_rows(tables, name):
    out = run(name, *tables)
    if name not in ("licenses", "decontam"):
        assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in ROWS)
    if name == "exact":
        one = [r for r in out if r.doc_id in (1, 9)]  # case counts
        assert {(r.keep_id, r.group_size) for r in one} == {(1, 3)} and sum(r.kept for r in one) == 1
        assert [(r.keep_id, r.group_size, r.kept) for r in out if r.doc_id == 2] == [(2, 1, True)]
        none = [r for r in out if r.doc_id in (3, 4) or r.doc_id is None and r.text_sha256.startswith("e3b0c442")]
        assert {(r.keep_id, r.group_size) for r in none} == {(3, 3)}
    if name == "secrets":
        assert {r.doc_id for r in out if r.n_assign} == {6, 7}
    if name == "simhash":
        assert all(r.fp == 0 for r in out if r.doc_id in (3, 4, 5)) and {r.component_id for r in out if r.doc_id in (1, 2, 9)} == {1}
    if name == "decontam":
        assert {(r.doc_id, r.item_id) for r in out} == {(6, 2), (7, 2)}


@pytest.mark.parametrize("name", ALL)
def test_empty_tables(tables, name):
    assert run(name, *(t.limit(0) for t in tables)) == []


@pytest.mark.parametrize("empty", [False, True])
def test_stages(spark, tables, tmp_path, empty):
    docs, labels, benchmark = (t.limit(0) if empty else t for t in tables)
    for name, t in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
        t.write.parquet(str(tmp_path / f"{name}.parquet"))
    now = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns = now.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        now = stage(spark, now, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert now.columns == columns
        now.write.parquet(str(tmp_path / f"out{i}"))
        now = spark.read.parquet(str(tmp_path / f"out{i}"))
    ids = sorted(str(r.doc_id) for r in now.collect())
    assert ids == ([] if empty else ids) and len(ids) == len(set(ids)) + ids.count("None") - bool(ids.count("None"))
    if not empty:
        assert "1" in ids and "2" not in ids and "9" not in ids and "6" not in ids and "8" in ids


@pytest.mark.parametrize("stage", [exact_dedup.without_copies, simhash.one_of_each, near.one_of_each])
def test_null_and_repeated_ids_lose_no_text(spark, stage):
    """A text of null ids only keeps one row, and an id that repeats with two texts loses the copy only."""
    same, clean = "a text that is there under the ids one and two", "quite another text that only the row two has in it"
    rows = [(None, "null ids only"), (None, "null ids  only"), (None, "null ids only"), (1, same), (2, same), (2, clean), (None, same)]
    left = [(r.doc_id, " ".join(r.text.split())) for r in stage(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert set(left) == {(None, "null ids only"), (1, same), (2, clean)} and (stage is not exact_dedup.without_copies or len(left) == 3)
