"""Licence scans: MinHash bands over overlapping text windows, then exact shingle containment.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of bytes of other scripts; a shingle is five words.
A template of n shingles is looked for in windows of W >= 2 (n + 1) shingles, a power of two, that start every W / 2, so each
occurrence lies whole in one of them. If a share c of the template's shingles is in the window, their
Jaccard similarity is at least c n / (W + (1 - c) n). With HASHES bands of one row, collision_probability() is over 0.99 for all
templates at the threshold. What is retrieved is verified exactly: a stretch where the share of the template's
distinct shingles is at least `share` (0.8). A template of under five words is one shingle of all its words, so only itself contains
it; such places are reported where no longer notice of the licence covers them. Null and empty texts hold nothing; templates without
words are refused. Repeated rows give repeated results.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, id_text, map_arrow
from .license_texts import TEMPLATES

SHINGLE, SHARE, HASHES, LEAST = 5, 0.8, 40, 8
#: Shingles that are hashed at once; long texts come in such parts, which overlap by the largest window.
PART = 1 << 15
_LETTER = np.zeros(256, np.uint8)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_VALUE = np.arange(256, dtype=np.uint64)
_VALUE[65:91] += np.uint64(32)
_K = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_K), -1, 1 << 64))
_rng = np.random.default_rng(5)
_A = _rng.integers(1, 2**63, HASHES).astype(np.uint64) | np.uint64(1)
_B = _rng.integers(1, 2**63, HASHES).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end byte of each word."""
    raw = np.frombuffer(text, np.uint8)
    edge = np.diff(_LETTER[raw], prepend=0, append=0).astype(np.int8)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUE[raw] * powers(_K, len(raw)), dtype=np.uint64)])
    return mixed((total[end] - total[start]) * powers(_INVERSE, len(raw))[start] + (end - start).astype(np.uint64)), start, end


def shingles(h: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of `size` words."""
    n = len(h) - size + 1
    out = np.zeros(max(0, n), np.uint64)
    for i in range(size if n > 0 else 0):
        out = out * np.uint64(0x2545F4914F6CDD1D) + h[i : n + i]
    return mixed(out)


def window(n: int) -> int:
    """Shingles of the windows in which templates of n shingles are looked for."""
    return max(LEAST, 1 << (2 * (n + 1) - 1).bit_length())


def collision_probability(n: int, share: float = SHARE) -> float:
    """At least so likely is a template of n shingles retrieved where a share of them is in the text."""
    kept = max(1, int(np.ceil(share * n)))
    return 1 - (1 - kept / (window(n) + n - kept)) ** HASHES


def hashed(s: np.ndarray) -> np.ndarray:
    """HASHES values of each shingle, one row a hash function."""
    return ((s[None, :] * _A[:, None] + _B[:, None]) >> np.uint64(32)).astype(np.uint32)


class Templates:
    def __init__(self, texts: dict[str, tuple[str, ...]]) -> None:
        self.names, self.sets, levels, self.short = [], [], {}, {}
        for name, versions in texts.items():
            for text in versions:
                h = words(text.encode())[0]
                if not len(h):
                    raise ValueError(f"a template of {name} has no words")
                s = np.unique(shingles(h, min(SHINGLE, len(h))))
                if len(h) < SHINGLE:
                    self.short.setdefault(len(h), []).append((int(s[0]), len(self.sets)))
                else:
                    levels.setdefault(window(len(s)), []).append(len(self.sets))
                self.names.append(name)
                self.sets.append(s)
        self.levels = {}
        for size, which in sorted(levels.items()):
            keys = {}
            for t in which:
                for i, least in enumerate(hashed(self.sets[t]).min(axis=1)):
                    keys.setdefault((i, int(least)), []).append(t)
            there = np.zeros(1 << 20, bool)
            there[[least & 0xFFFFF for _, least in keys]] = True
            self.levels[size] = (keys, there)
        self.largest = max(self.levels, default=LEAST)


def retrieved(s: np.ndarray, t: Templates) -> set[tuple[int, int, int]]:
    """(template, from, to): windows of shingles that share a band with a template."""
    out = set()
    for at in range(0, max(1, len(s) - t.largest), PART):
        part = s[at : at + PART + t.largest]
        least = hashed(part)
        size = LEAST // 2
        pad = -len(part) % size
        if pad:
            least = np.concatenate([least, np.full((HASHES, pad), 2**32 - 1, np.uint32)], axis=1)
        least = least.reshape(HASHES, -1, size).min(axis=2)
        while True:  # least: of each half window
            both = np.minimum(least[:, :-1], least[:, 1:]) if least.shape[1] > 1 else least
            if 2 * size in t.levels:
                keys, there = t.levels[2 * size]
                for i, w in np.argwhere(there[both & np.uint32(0xFFFFF)]).tolist():
                    for k in keys.get((i, int(both[i, w])), ()):
                        out.add((k, at + w * size, min(len(s), at + (w + 2) * size)))
            if 2 * size >= t.largest:
                break
            if least.shape[1] % 2:
                least = np.concatenate([least, np.full((HASHES, 1), 2**32 - 1, np.uint32)], axis=1)
            least, size = np.minimum(least[:, ::2], least[:, 1::2]), 2 * size
    return out


def verified(s: np.ndarray, found: set[tuple[int, int, int]], t: Templates, share: float) -> Iterator[tuple[int, int, int, float]]:
    """(template, first and last shingle, share) of each stretch that holds enough of a template's shingles."""
    for k in sorted({x[0] for x in found}):
        own, spans = t.sets[k], []
        for a, b in sorted(x[1:] for x in found if x[0] == k):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], b)
            else:
                spans.append([a, b])
        for a, b in spans:
            at = a + np.flatnonzero(np.isin(s[a:b], own))
            yield from occurrences(k, s, at, own, share)


def occurrences(k: int, s: np.ndarray, at: np.ndarray, own: np.ndarray, share: float) -> Iterator[tuple[int, int, int, float]]:
    """Splits the places of a template's shingles into stretches no longer than twice the template, and yields those with enough."""
    while len(at):
        here = at[: np.searchsorted(at, at[0] + 2 * len(own))]
        kinds = [int(x) for x in s[here]]
        first = next((i for i in range(1, len(kinds)) if kinds[i] == kinds[0] and len(set(kinds[:i])) >= share * len(own)), None)
        here = here[:first]
        got = len(set(kinds[: len(here)])) / len(own)
        if got >= share:
            yield k, int(here[0]), int(here[-1]), got
            at = at[len(here) :]
        else:
            at = at[1:]


def places(h: np.ndarray, t: Templates, share: float) -> list[tuple[int, int, int, float]]:
    """(template, first and last word, share) of all places in a text of words h."""
    s = shingles(h)
    out = [(k, a, b + SHINGLE - 1, got) for k, a, b, got in verified(s, retrieved(s, t), t, share)] if len(s) and t.levels else []
    for size, own in t.short.items():
        runs = shingles(h, size)
        for value, k in own:
            covered = [(a, b) for j, a, b, _ in out if t.names[j] == t.names[k]]
            out += [(k, a, a + size - 1, 1.0) for a in np.flatnonzero(runs == np.uint64(value)).tolist() if not any(c <= a and a + size - 1 <= d for c, d in covered)]
    return out


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None, share: float = SHARE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, license, template (its number), share, start_byte, end_byte of each place that holds a template.

    The templates are a stated set that the caller gives; they are sent to the tasks.
    """
    sent = docs.sparkSession.sparkContext.broadcast(TEMPLATES if templates is None else templates)

    def start():
        t = Templates(sent.value)

        def f(batch: pa.RecordBatch) -> Iterator[dict]:
            ids = batch.column(0).to_pylist()
            for at, texts in byte_chunks(batch.column(1)):
                out = []
                for i, text in enumerate(texts):
                    h, begin, end = words(text)
                    out += [(ids[at + i], t.names[k], k, got, int(begin[a]), int(end[b])) for k, a, b, got in places(h, t, share)]
                yield dict(zip(("doc_id", "license", "template", "share", "start_byte", "end_byte"), map(list, zip(*out)) if out else [[]] * 6))

        return f

    return map_arrow(id_text(docs, id_col, text_col), start, "doc_id long, license string, template int, share double, start_byte long, end_byte long", once_a_task=True)
