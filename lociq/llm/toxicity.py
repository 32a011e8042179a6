"""Toxicity: a bidirectional gated recurrent network with attention pooling, over all overlapping windows of a text.

A word's input is a hashed word embedding beside the scaled sum of its hashed character n-gram embeddings (3 to 5
characters' bytes with marks at both ends, A-Z lower-cased).
A word of over PART bytes is cut into parts that overlap by so many bytes that each n-gram lies whole in a part; each part is
a word of the windows, so scripts without spaces are read to their end too.
Windows of WINDOW words start every STRIDE words, to the end of the text. A document's logit is the largest of
its windows'; training passes the document's gradient to that window. It is trained in numpy by Adam on a sample
bounded by the parameter max_train, then calibrated on it. Null and empty texts have no window and get the score of
an empty context; without any labels each score is 0.5. Repeated rows give repeated results.
"""
from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER, byte_chunks, id_text, keep_rows, labelled_sample, map_arrow, platt, sigmoid

WINDOW, STRIDE = 32, 24
PART, OVERLAP = 64, 4
WORDS, GRAMS, DIM, HIDDEN, ATTENTION = 1 << 13, 1 << 14, 12, 8, 8
#: Embeddings learn more slowly than what reads them, so a few documents aren't learnt by heart; and at least so many batches.
EMBEDDING_RATE, STEPS = 0.3, 60


def squash(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def parts(w: bytes) -> list[bytes]:
    return [w[i : i + PART] for i in range(0, max(1, len(w) - OVERLAP), PART - OVERLAP)]


def tokens(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, long ones in parts, A-Z lower-cased."""
    words = text.translate(LOWER).split()
    return [x for w in words for x in parts(w)] if max(map(len, words), default=0) > PART else words


def word_of(text: bytes, token: int) -> int:
    """The place among the words of the one that holds a token."""
    words = text.split()
    if token and max(map(len, words)) > PART:
        return int(np.searchsorted(np.cumsum([len(parts(w)) for w in words]), token, side="right"))
    return token


class Vocabulary:
    """Ids of distinct words, with the slots of their embeddings, kept flat."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.word, self.grams, self.ends = array("i"), array("i"), array("q", [0])

    def add(self, words: list[bytes]) -> np.ndarray:
        ids, out = self.ids, []
        for w in words:
            k = ids.get(w)
            if k is None:
                k = ids[w] = len(ids)
                self.word.append(zlib.crc32(w) % WORDS)
                p = b"^" + w + b"$"
                self.grams.extend([zlib.crc32(p[i : i + n], 1) % GRAMS for n in (3, 4, 5) for i in range(len(p) - n + 1)] or [0])
                self.ends.append(len(self.grams))
            out.append(k)
        return np.array(out, np.int32)

    def slots(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word slots, all n-gram slots, and how many of these each word has."""
        ends = np.frombuffer(self.ends, np.int64)
        start, n = ends[at], ends[at + 1] - ends[at]
        flat = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.frombuffer(self.word, np.int32)[at], np.frombuffer(self.grams, np.int32)[flat], n


def windows(n: int) -> np.ndarray:
    """Starts of the overlapping windows over n words."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else np.arange(0)


def cut(ids: np.ndarray) -> np.ndarray:
    """Word ids of each window, -1 after the end of the text."""
    starts = windows(len(ids))
    padded = np.append(ids, np.full(WINDOW, -1, ids.dtype))
    return padded[starts[:, None] + np.arange(WINDOW)]


class Network:
    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s, sd: rng.normal(0, sd, s).astype(np.float32)
        self.p = {
            "words": draw(WORDS, DIM, sd=0.02), "grams": draw(GRAMS, DIM, sd=0.02), "wx": draw(2 * DIM, 6 * HIDDEN, sd=0.3), "bx": np.zeros(6 * HIDDEN, np.float32),
            "u": draw(2, HIDDEN, 3 * HIDDEN, sd=0.3), "wa": draw(2 * HIDDEN, ATTENTION, sd=0.3), "ba": np.zeros(ATTENTION, np.float32), "va": draw(ATTENTION, sd=0.3),
            "wo": draw(2 * HIDDEN, sd=0.3), "bo": np.zeros(1, np.float32),
        }
        self.slope, self.shift = 0.0, 0.0

    def inputs(self, slots: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
        word, grams, n = slots
        total = np.add.reduceat(self.p["grams"][grams], np.cumsum(n) - n, axis=0) / np.sqrt(n)[:, None] if len(n) else np.zeros((0, DIM), np.float32)
        return np.concatenate([self.p["words"][word], total], axis=1).astype(np.float32)

    def all_gates(self, vocabulary: Vocabulary, first: int = 0, at_once: int = 8192) -> np.ndarray:
        """Gate inputs of the words from first on."""
        n = len(vocabulary.ids)
        parts = [self.gates(self.inputs(vocabulary.slots(np.arange(i, min(n, i + at_once)))))[:-1] for i in range(first, n, at_once)]
        return np.concatenate([*parts, np.zeros((1, 2, 3 * HIDDEN), np.float32)])

    def gates(self, inputs: np.ndarray) -> np.ndarray:
        """Gate inputs of each distinct word in both directions, and a row of zeros for the padding."""
        g = (inputs @ self.p["wx"] + self.p["bx"]).reshape(-1, 2, 3 * HIDDEN)
        return np.concatenate([g, np.zeros((1, 2, 3 * HIDDEN), np.float32)])

    def forward(self, gates: np.ndarray, ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict]:
        """Logit of each window in ids (windows, WINDOW); keep: what backward needs."""
        p, b = self.p, len(ids)
        order = ids.T
        x = np.stack([gates[order, 0], gates[order[::-1], 1]], axis=1)  # step, direction, window, gate
        real = (ids >= 0).T
        mask = np.stack([real, real[::-1]], axis=1)[..., None].astype(np.float32)
        full = bool(real.all())
        h, states, saved = np.zeros((2, b, HIDDEN), np.float32), np.empty((WINDOW, 2, b, HIDDEN), np.float32), []
        for t in range(WINDOW):
            hu = h @ p["u"]
            zr = squash(x[t, :, :, : 2 * HIDDEN] + hu[..., : 2 * HIDDEN])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            c = np.tanh(x[t, :, :, 2 * HIDDEN :] + r * hu[..., 2 * HIDDEN :])
            new = c + z * (h - c)
            if keep:
                saved.append((h, z, r, c, hu[..., 2 * HIDDEN :]))
            h = new if full else h + mask[t] * (new - h)
            states[t] = h
        s = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)  # step, window, both directions
        a = np.tanh(s @ p["wa"] + p["ba"])
        e = np.where(real, a @ p["va"], -1e9)
        e = np.exp(e - e.max(axis=0, initial=-1e9))
        alpha = e * real / np.maximum((e * real).sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", alpha, s)
        logit = pooled @ p["wo"] + p["bo"][0]
        return logit, {"s": s, "a": a, "alpha": alpha, "pooled": pooled, "saved": saved, "mask": mask, "ids": ids} if keep else {}

    def backward(self, d: np.ndarray, k: dict, slots: tuple[np.ndarray, np.ndarray, np.ndarray], inputs: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients from d, those of the logits."""
        p, g = self.p, {}
        s, a, alpha = k["s"], k["a"], k["alpha"]
        g["wo"], g["bo"] = k["pooled"].T @ d, np.array([d.sum()], np.float32)
        dp = d[:, None] * p["wo"]
        ds = alpha[..., None] * dp
        dalpha = np.einsum("bh,tbh->tb", dp, s)
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        g["va"] = np.einsum("tb,tba->a", de, a)
        da = de[..., None] * p["va"] * (1 - a * a)
        g["wa"], g["ba"] = np.einsum("tbh,tba->ha", s, da), da.sum(axis=(0, 1))
        ds = ds + da @ p["wa"].T
        dstate = np.stack([ds[..., :HIDDEN], ds[::-1, :, HIDDEN:]], axis=1)
        dx, dh, g["u"] = np.empty((WINDOW, *dstate.shape[1:3], 3 * HIDDEN), np.float32), 0, np.zeros_like(p["u"])
        for t in range(WINDOW - 1, -1, -1):
            h, z, r, c, hn = k["saved"][t]
            dh = dh + dstate[t]
            dn = dh * k["mask"][t]
            dc = dn * (1 - z) * (1 - c * c)
            dz = dn * (h - c) * z * (1 - z)
            dr = dc * hn * r * (1 - r)
            dx[t] = np.concatenate([dz, dr, dc], axis=2)
            du = np.concatenate([dz, dr, dc * r], axis=2)
            g["u"] += np.swapaxes(h, 1, 2) @ du
            dh = dh * (1 - k["mask"][t]) + dn * z + du @ np.swapaxes(p["u"], 1, 2)
        order = k["ids"].T
        dgates = np.zeros((len(inputs) + 1, 2, 3 * HIDDEN), np.float32)
        np.add.at(dgates[:, 0], order, dx[:, 0])
        np.add.at(dgates[:, 1], order[::-1], dx[:, 1])
        flat = dgates[:-1].reshape(-1, 6 * HIDDEN)
        g["wx"], g["bx"] = inputs.T @ flat, flat.sum(axis=0)
        din = flat @ p["wx"].T
        word, grams, n = slots
        g["words"], g["grams"] = np.zeros_like(p["words"]), np.zeros_like(p["grams"])
        np.add.at(g["words"], word, din[:, :DIM])
        np.add.at(g["grams"], grams, np.repeat(din[:, DIM:] / np.sqrt(n)[:, None], n, axis=0))
        return g

    def documents(self, gates: np.ndarray, docs: list[np.ndarray], at_once: int = 1024) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Largest window logit, its window, and all window logits of each document, given its word ids."""
        cuts = [cut(x) for x in docs]
        n = np.array([len(c) for c in cuts])
        every = np.concatenate([*cuts, np.zeros((0, WINDOW), np.int32)])
        del cuts
        logits = np.concatenate([self.forward(gates, every[i : i + at_once])[0] for i in range(0, len(every), at_once)] or [np.zeros(0, np.float32)])
        each = np.split(logits, np.cumsum(n)[:-1]) if len(n) else []
        most = np.array([x.max() if len(x) else self.p["bo"][0] for x in each], np.float64)
        return most, np.array([int(x.argmax()) if len(x) else -1 for x in each], np.int64), each

    def score(self, logit: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * logit + self.shift)


def log_odds(slots: Iterator[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Of each slot: how much likelier a toxic document holds it, in logs, shrunk where it is rare."""
    has = np.ones((2, size))
    for x, label in zip(slots, y):
        has[int(label), np.unique(x)] += 1
    rate = has / np.array([[(y == 0).sum() + 2], [(y == 1).sum() + 2]])
    return (np.log(rate[1] / rate[0]) * (1 - np.exp(-(has.sum(axis=0) - 2) / 8))).astype(np.float32)


def train(rows: list[tuple[int, bytes, int]], epochs: int = 5, batch: int = 64, rate: float = 0.01, seed: int = 11) -> Network:
    net = Network(seed)
    if not rows:
        return net
    vocabulary, rng = Vocabulary(), np.random.default_rng(seed)
    docs = [vocabulary.add(tokens(t)) for _, t, _ in rows]
    y = np.array([label for *_, label in rows], np.float64)
    # A start that sees single words and n-grams.
    net.p["words"][:, 0] = np.clip(log_odds((vocabulary.slots(x)[0] for x in docs), y, WORDS), -3, 3)
    net.p["grams"][:, 0] = np.clip(log_odds((vocabulary.slots(np.unique(x))[1] for x in docs), y, GRAMS), -3, 3)
    m, v, step = {k: np.zeros_like(x) for k, x in net.p.items()}, {k: np.zeros_like(x) for k, x in net.p.items()}, 0
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
    epochs = max(epochs, -(-STEPS * batch // len(docs)))
    for epoch in range(epochs):
        gates = None
        for i, some in enumerate(np.array_split(rng.permutation(len(docs)), max(1, len(docs) // batch))):
            if i % 8 == 0:  # windows are chosen by parameters that are a few steps old
                gates = net.all_gates(vocabulary)
            full = [d for d in some if len(docs[d])]
            if not full:
                continue
            _, worst, _ = net.documents(gates, [docs[d] for d in full])
            ids = np.stack([cut(docs[d])[w] for d, w in zip(full, worst)])
            own, local = np.unique(ids, return_inverse=True)
            local = local.reshape(ids.shape) - (own[0] < 0)
            own = own[own >= 0]
            part = vocabulary.slots(own)
            x = net.inputs(part)
            logit, kept = net.forward(net.gates(x), local.astype(np.int32), keep=True)
            d = ((sigmoid(logit) - y[full]) * weight[full] / len(full)).astype(np.float32)
            grads = net.backward(d, kept, part, x)
            step += 1
            lr = rate * (0.5 if epoch >= epochs - 2 else 1)
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.01 * (g * g - v[k])
                net.p[k] -= lr * (EMBEDDING_RATE if k in ("words", "grams") else 1) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)
    most, _, _ = net.documents(net.all_gates(vocabulary), docs)
    net.slope, net.shift = platt(most, y)
    return net


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, max_train: int = 3000) -> Network:
    return train(labelled_sample(docs, labels, label, folds, max_train))


class Scorer:
    """A network with the words that a task has met, whose gate inputs are kept."""

    def __init__(self, net: Network) -> None:
        self.net = net
        self.forget()

    def forget(self) -> None:
        self.vocabulary, self.gates = Vocabulary(), np.zeros((1, 2, 3 * HIDDEN), np.float32)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Score, deciding window and logits of all windows of each text."""
        if len(self.vocabulary.ids) > 100_000:
            self.forget()
        ids = [self.vocabulary.add(tokens(t)) for t in texts]
        self.gates = np.concatenate([self.gates[:-1], self.net.all_gates(self.vocabulary, len(self.gates) - 1)])
        most, worst, each = self.net.documents(self.gates, ids)
        return self.net.score(most), worst, each


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, n_windows, worst_start (first word of the window that decides; null without words) of every row.

    The network has a fixed size of under 2 MB.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def start():
        scorer = Scorer(sent.value)

        def f(batch: pa.RecordBatch) -> Iterator[dict]:
            for at, texts in byte_chunks(batch.column(1), 1 << 20):
                scores, worst, each = scorer(texts)
                yield {"doc_id": batch.column(0).slice(at, len(texts)), "score": scores, "n_windows": [len(x) for x in each], "worst_start": [word_of(t, int(w) * STRIDE) if w >= 0 else None for t, w in zip(texts, worst)]}

        return f

    return map_arrow(id_text(docs, id_col, text_col), start, "doc_id long, score double, n_windows long, worst_start long", once_a_task=True)


def clean(docs: DataFrame, net: Network, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, that score under the threshold."""
    sent = docs.sparkSession.sparkContext.broadcast(net)

    def start():
        scorer = Scorer(sent.value)
        return lambda texts: scorer(texts)[0] < threshold

    return keep_rows(docs, text_col, start)
