"""Links of crowded entries: all of them, without all pairs."""
import itertools
import random

import pytest

from lociq.llm import near


def drawn(seed, groups, size, shares):
    """Groups of texts that keep a base's words but for a share each."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(10**6)}" for _ in range(size)]
        for k, share in enumerate(shares):
            out.append(" ".join(w if rng.random() >= share else f"x{g}-{k}-{rng.randrange(10**6)}" for w in base))
    return out


def roots(texts):
    sets, root = [set(near.shingles(t.encode()).tolist()) for t in texts], list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            x, y = sorted((root[a], root[b]))
            root = [x if r == y else r for r in root]
    return root


@pytest.mark.parametrize("seed,groups,size,shares", [(1, 3, 60, [0.0] * 3 + [0.02] * 30 + [0.04] * 30), (2, 2, 90, [0.01, 0.02, 0.03, 0.05] * 12), (3, 30, 12, [0.02] * 3)])
def test_all_links_of_components(spark, seed, groups, size, shares):
    """Candidates hold every similar pair of different components, whatever the components."""
    texts = drawn(seed, groups, size, shares)
    grams = {i: set(near.shingles(t.encode()).tolist()) for i, t in enumerate(texts)}
    rng = random.Random(seed)
    comp = [(i, 10**6 + rng.randrange(4)) for i in range(len(texts))]
    found = near.candidates(spark.createDataFrame(comp, "node long, c long"), near.sets(spark.createDataFrame(list(enumerate(texts)), "node long, text string")))
    got = {(r.u, r.v) for r in found.collect()}
    want = {(a, b) for a, b in itertools.combinations(range(len(texts)), 2) if comp[a][1] != comp[b][1] and 5 * len(grams[a] & grams[b]) >= 4 * len(grams[a] | grams[b])}
    assert want and want <= got


def test_unlinked_near_copies_make_no_pairs(spark):
    """300 texts of a base, each with some words of its own, so that no two are linked: all pairs would be 44850."""
    texts = drawn(7, 1, 200, [0.05] * 300)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    nodes = docs.select(near.node("text").alias("node"), "text")
    alone = nodes.selectExpr("node", "node as c")
    assert near.candidates(alone, near.sets(nodes)).count() < 3000
    want = roots(texts)
    assert {r.doc_id for r in near.one_of_each(docs).collect()} == {i for i, r in enumerate(want) if i == r}


def test_stage_links_by_simhash_too(spark):
    """The pipeline's near-dedup takes the links of both methods: by fingerprint alone, by similarity alone, and across them."""
    import corpus_pipeline
    from lociq.llm import near, simhash

    phrase, words = "one two three four five six seven eight ", [f"w{i}" for i in range(60)]
    loud = [phrase * 60 + f"tail {x} with some words of its own {x}{x}" for x in ("alpha", "beta")]
    similar = [" ".join(words), " ".join([*words[:-2], "x", "y"])]
    docs = spark.createDataFrame([*enumerate([*loud, *similar, "a text apart from all of these"])], "doc_id long, text string")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    assert ids(near.one_of_each(docs)) == [0, 1, 2, 4]
    assert 1 not in ids(simhash.one_of_each(docs)) and ids(corpus_pipeline.without_near_copies(spark, docs, "")) == [0, 2, 4]
