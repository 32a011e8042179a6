"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

A document's features are its word unigrams and bigrams (A-Z lower-cased), and unigrams to trigrams of its words' shapes
(letters as a or A, digits as 0, a repeated word as =), hashed to 2**bits slots and weighted by their share of the document. The score is a sparse dot product, calibrated on the training sample. The sample is bounded by the
parameter max_train. Null and empty texts get the model's score for no features; without any labels each score is 0.5.
Repeated rows give repeated results.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, byte_chunks, id_text, labelled_sample, map_arrow, platt, sigmoid

#: A document's shares are multiplied by this, so that gradients aren't tiny.
SCALE = 20.0


#: Bytes by kind: A, a (letters, and all bytes of other scripts), 0, or themselves.
SHAPES = bytes.maketrans(bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(48, 58)) + bytes(range(128, 256)), b"A" * 26 + b"a" * 26 + b"0" * 10 + b"a" * 128)
RUNS = re.compile(rb"(.)\1+", re.DOTALL)
SAME = zlib.crc32(b"=")


class WordHash(dict):
    """crc32 of a word, lower-cased, and of its shape as one number, kept; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = zlib.crc32(word.translate(LOWER)) << 32 | zlib.crc32(RUNS.sub(rb"\1", word.translate(SHAPES)))
        return h


def pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA77))
    return x ^ (x >> np.uint32(15))


def slots(text: bytes, hashes: WordHash, bits: int) -> np.ndarray:
    """Slot of each n-gram of words and of shapes, repeats included."""
    both = np.array([hashes[w] for w in text.split()], np.uint64)
    h, shape = (both >> np.uint64(32)).astype(np.uint32), both.astype(np.uint32)
    shape[1:][h[1:] == h[:-1]] = SAME
    two = pair(shape[:-1], shape[1:])
    found = np.concatenate([h, pair(h[:-1], h[1:]), shape, two, pair(two[:-1], shape[2:])])
    return (found & np.uint32((1 << bits) - 1)).astype(np.int64)


@dataclass
class Model:
    bits: int
    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def logit(self, at: np.ndarray) -> float:
        return self.bias + (SCALE * float(self.weights[at].sum()) / len(at) if len(at) else 0.0)

    def score(self, at: np.ndarray) -> float:
        return float(sigmoid(self.slope * self.logit(at) + self.shift))


def train(rows: list[tuple[int, bytes, int]], bits: int = 18, epochs: int = 3, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1, seed: int = 7) -> Model:
    """FTRL-proximal with a learning rate for each slot; the last slot is the bias."""
    model = Model(bits, np.zeros((1 << bits) + 1, np.float64))
    if not rows:
        return model
    hashes, docs = WordHash(), []
    for _, text, y in rows:
        at, n = np.unique(slots(text, hashes, bits), return_counts=True)
        docs.append((np.append(at, 1 << bits), np.append(SCALE * n / max(1, n.sum()), 1.0), y))
    z, g2, w = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1), model.weights
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, x, y = docs[i]
            zi, ni = z[at], g2[at]
            wi = np.where(abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
            w[at] = wi
            g = (sigmoid(wi @ x) - y) * x
            z[at] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha * wi
            g2[at] = ni + g * g
    w[:] = np.where(abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(g2)) / alpha + l2))
    model.bias, model.weights = float(w[-1]), w[:-1].astype(np.float32)
    logits = np.array([w[at] @ x for at, x, _ in docs])
    model.slope, model.shift = platt(logits, np.array([y for *_, y in docs], float))
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, max_train: int = 4000) -> Model:
    return train(labelled_sample(docs, labels, label, folds, max_train))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_features of every row. The model has a fixed size, 4 bytes a slot."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        m, hashes = sent.value, WordHash()

        def f(batch: pa.RecordBatch) -> Iterator[dict]:
            for at, texts in byte_chunks(batch.column(1)):
                found = [slots(t, hashes, m.bits) for t in texts]
                yield {"doc_id": batch.column(0).slice(at, len(texts)), "score": [m.score(x) for x in found], "n_features": [len(x) for x in found]}

        return f

    return map_arrow(id_text(docs, id_col, text_col), start, "doc_id long, score double, n_features long", once_a_task=True)
