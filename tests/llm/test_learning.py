"""Learning on documents: held-out results on the tables, calibration, and a hot key of exact dedup."""
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lociq.llm import common, exact_dedup, pii, toxicity


def tables(sf):
    d = pq.read_table(f"/root/testdata/{sf}/documents.parquet").to_pydict()
    labels = pq.read_table(f"/root/testdata/{sf}/labels.parquet").to_pydict()
    return dict(zip(d["doc_id"], d["text"])), labels


def held_out(i, n=5):
    return zlib.crc32(str(i).encode()) % n == 0


def test_toxicity_beats_the_majority_on_few_documents():
    texts, labels = tables("sf0.01")
    rows = sorted({i: (i, texts[i].encode(), y) for i, y in zip(labels["doc_id"], labels["toxic"])}.values())
    net = toxicity.train([r for r in rows if not held_out(r[0])])
    out = [r for r in rows if held_out(r[0])]
    score, y = toxicity.Scorer(net)([t for _, t, _ in out])[0], np.array([r[2] for r in out])
    assert ((score >= 0.5) == y).mean() > max(y.mean(), 1 - y.mean()) and ((score >= 0.5) & (y == 1)).sum() >= 3


def test_places_of_many_keys():
    from lociq.llm import mixing

    rng = np.random.default_rng(1)
    for n in (1 << 22, (1 << 22) + 7):
        keys = rng.integers(0, 1 << 42, n).astype(np.uint64)
        keys[: n // 3] = keys[n // 3 : 2 * (n // 3)]
        u, place = mixing.distinct(keys.copy())
        assert np.array_equal(u[place], keys) and (np.diff(u.astype(np.int64)) > 0).all()


def test_calibration_of_logits_that_part_the_labels():
    for scale in (1e-3, 1.0, 50.0):
        x = np.r_[np.linspace(-3, -1, 200), np.linspace(1, 3, 10)] * scale
        y = np.r_[np.zeros(200), np.ones(10)]
        a, b = common.platt(x, y)
        p = common.sigmoid(a * x + b)
        assert a > 0 and np.isfinite([a, b]).all() and (np.diff(p) >= 0).all() and (scale < 0.1 or ((p >= 0.5) == y).all())


def test_personal_data_of_documents(spark):
    texts, _ = tables("sf0.01")
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    trained = pii.training_texts(docs, 500)
    assert set(trained) <= {t for i, t in texts.items() if not held_out(i)} and len(pii.training_texts(docs, 7)) == 7
    found = pii.quality_by_kind(pii.train(trained), [t for i, t in texts.items() if held_out(i)])
    assert set(found) == set(pii.BASE)
    for kind, (n, precision, recall) in found.items():
        assert n and recall >= 0.9 and precision >= (0.6 if kind == "card" else 0.9), (kind, n, precision, recall)


@pytest.mark.parametrize("text", ["fe80::1", "2001:db8::8a2e:370:7334", "::1", "2001:0db8:85a3:0000:0000:8a2e:0370:7334", "1:2:3:4:5:6:7:8"])
def test_short_addresses_are_proposed(text):
    assert (pii.KINDS.index("ipv6"), text) in {(k, f"at {text}, up"[a:b]) for a, k, b in pii.candidates(f"at {text}, up")}


def test_exact_dedup_of_rows_without_ids(spark):
    """Most rows have no id and the same text: salts are dealt by row, and results are those of a plain version."""
    n = 20000
    docs = spark.range(n).repartition(6).select(F.when(F.col("id") % 10 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("one text that many rows have")).otherwise(F.concat(F.lit("text "), (F.col("id") % 500).cast("string"))).alias("text"))
    out = exact_dedup.exact_duplicates(docs, salts=16)
    rows = [(None if i % 10 else i, "one text that many rows have" if i % 3 == 0 else f"text {i % 500}") for i in range(n)]
    size, least = {}, {}
    for i, t in rows:
        size[t] = size.get(t, 0) + 1
        least[t] = min(least.get(t, 1 << 62), 1 << 62 if i is None else i)
    import hashlib

    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in size}
    got = out.collect()
    assert len(got) == n
    kept = {}
    for r in got:
        t = sha[r.text_sha256]
        assert r.group_size == size[t] and r.keep_id == (None if least[t] == 1 << 62 else least[t])
        kept[t] = kept.get(t, 0) + r.kept
    assert set(kept.values()) == {1}
