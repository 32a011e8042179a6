import random

import numpy as np
import pyarrow as pa

from lociq.llm import mixing
from lociq.llm.common import LOWER
from tests.llm.test_brute import forest_of, prose


def block(seed: int, n: int = 40):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 60)).encode() for _ in range(n)] + [b"", "é œ ".encode() * 9]
    return texts, np.array([rng.choice([0, 1, 1, 2]) for _ in texts], np.uint64)


def test_start_weights_come_from_the_one_count_of_a_block(monkeypatch):
    """A block's pairs are counted once, for its lists and its weights; these are those of its tuning texts, coded by the counts of its other training texts."""
    texts, roles = block(21)
    forest, calls, counts = forest_of(texts), [], mixing.pair_counts
    monkeypatch.setattr(mixing, "pair_counts", lambda *x: calls.append(x) or counts(*x))
    out = list(mixing.listed(texts, roles, forest, 3))
    assert len(calls) == 1
    (*_, size, weights, _), = (x for x in out if x[0] == mixing.WEIGHTS)
    tune, others, answers = *([t for t, r in zip(texts, roles) if r == role] for role in (2, 1)), []
    for kind, ((k, n, _), (own, *_)) in enumerate(zip(counts(others, np.ones(len(others), np.uint64), forest), counts(tune, np.zeros(len(tune), np.uint64), forest))):
        keys, n = mixing.added(np.concatenate([k, own]), np.concatenate([n, np.zeros(len(own), np.int64)]))
        answers.append(mixing.Values.of(kind, keys, n, forest).at(np.searchsorted(keys, own)))
    _, want = mixing.Coder(forest, tune, answers).bits(np.tile(mixing.FIRST, (mixing.GATES, 1)), learn=True)
    assert size == want.size and np.array_equal(np.frombuffer(weights), want.ravel()) and not np.allclose(want, mixing.FIRST)
    assert {x[0] for x in out} == {*range(mixing.PREDICTORS), mixing.WEIGHTS}
    (*_, size, weights, _), = (x for x in mixing.listed(texts, roles * (roles < 2), forest, 3) if x[0] == mixing.WEIGHTS)
    assert (size, weights) == (0, b"")


def test_tokens_and_their_owners():
    rng = random.Random(22)
    texts = [b"", b" ", b"A a\t\x0bB\n", b"x" * 700 + b" " + b"x" * 700, b"x" * 699 + b"y", b"\x1c 1", *(prose(rng, 50).encode() for _ in range(30)), b" \r\n"]
    words, every, n = mixing.tokens(texts)
    assert [w[:-1] for w in words.take(pa.array(every)).to_pylist()] == [w for t in texts for w in [*t.translate(LOWER).split(), b""]]
    assert n.tolist() == [len(t.split()) + 1 for t in texts]
    assert words[0].as_py() == b"\n" and len(set(words.to_pylist())) == len(words)
    parts = mixing.by_part(words, 5)
    assert sorted(np.concatenate(list(parts.values())).tolist()) == list(range(len(words)))
    again, every, _ = mixing.tokens(texts[2:])  # other lists of the same tokens have the same owners
    own = {w: p for p, at in parts.items() for w in words.take(pa.array(at)).to_pylist()}
    assert all(own[w] == p for p, at in mixing.by_part(again, 5).items() for w in again.take(pa.array(at)).to_pylist())
    assert mixing.lines(np.frombuffer(words.buffers()[2], np.uint8)).to_pylist() == words.to_pylist()
    assert [x.tolist() for x in mixing.tokens([b"", b""])[1:]] == [[0, 0], [1, 1]]


def test_owners_places_are_those_of_the_keys():
    rng = np.random.default_rng(23)
    lists = [np.unique(rng.integers(0, 900, 400).astype(np.uint64)) for _ in range(4)] + [np.array([7], np.uint64)]
    n = rng.integers(0, 9, sum(map(len, lists)))
    keys, sums, places = mixing.merged(lists, n)
    assert np.array_equal(keys, np.unique(np.concatenate(lists))) and all(np.array_equal(keys[p], own) for p, own in zip(places, lists))
    assert np.array_equal(sums, np.bincount(np.searchsorted(keys, np.concatenate(lists)), n))


def test_paths_longer_than_the_heads():
    """Each decision's value, near or beyond the HEAD that are looked up as one, is its own: the bits of a text are those of a plain sum over its decisions."""
    rng = np.random.default_rng(24)
    texts = [bytes(rng.choice(255, 90, p=(p := 0.9 ** np.arange(255)) / p.sum()).astype(np.uint8)) for _ in range(30)]
    forest = forest_of(texts)
    start = np.tile(mixing.FIRST, (mixing.GATES, 1))
    answers = [mixing.Values.of(kind, k, n, forest).at(np.arange(len(k))) for kind, (k, n, _) in enumerate(mixing.pair_counts(texts, np.ones(len(texts), np.uint64), forest))]
    bits = mixing.Coder(forest, texts, answers).bits(start)[0]
    coder = mixing.Coder(forest, texts, answers)
    segment, = coder.segments
    codes, values = segment.codes(forest), []
    for (flags, several), keys in zip(answers, (*(mixing.spread(mixing.shorter(segment.strings(), o)) for o in mixing.ORDERS), segment.word_pairs(forest))):
        every, place = np.unique(keys, return_inverse=True)
        of, at = {}, 0
        for i, flag in enumerate(flags.tolist()):
            size = int(forest.length[codes[np.argmax(place == i)]])
            of[i] = [flag] * size if flag != mixing.SEVERAL else several[at : at + size].tolist()
            at += size * (flag == mixing.SEVERAL)
        values.append([of[i] for i in place.tolist()])
    assert forest.length[codes].max() > mixing.HEAD
    # Texts of fewer bytes than BLOCK are coded by the start weights.
    want = [sum(np.log2(1 + np.exp(np.clip(-float(mixing.STEP) * (mixing.FIRST @ np.array(x)), -16, 16))) for at in range(a, a + n) for x in zip(*(v[at] for v in values))) for a, n in zip(segment.first, segment.size)]
    assert np.allclose(bits, want, rtol=1e-5)
