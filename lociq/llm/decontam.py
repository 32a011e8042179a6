"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared with A-Z lower-cased, each run of white space as one space, trimmed. A test item of m characters may
occur in a document with at most k = floor(rate * m) edits. It is split into k + 1 pieces: any such occurrence holds one of them
unchanged, so an Aho-Corasick automaton over all distinct pieces finds every place to look at, and Myers' bit-parallel edit
distance, over many places at once in numpy, decides.

Places beside each other are looked at together, as one stretch; stretches are cut into lanes of about the pattern's length, so a
text that repeats a piece at every position costs its length once for each item, not once a hit. Texts are searched in parts of
PART characters that overlap by the longest occurrence, so memory doesn't grow with a text.

The benchmark is a stated query set of at most MOST_CHARS characters. It is sent to the tasks in blocks of at most BLOCK_CHARS; each
block is a pass over the documents, so a larger benchmark needs more passes, not more memory.
Null and empty texts match nothing; null and empty items are left out; an item id that repeats counts once for each different
text. Documents that repeat are each reported. Without documents or items the result is empty.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, byte_chunks, id_text, keep_rows

#: Share of an item's characters that may be edited.
RATE = 0.1
#: Pieces that are verified together before the whole item is.
GROUP = 4
BLOCK_CHARS, MOST_CHARS = 500_000, 100_000_000
#: Pairs verified at once, about.
AT_ONCE = 2048
#: Characters searched at once; hits at most GAP apart are one stretch; places that are expanded at once.
PART, GAP, EXPANDED = 1 << 20, 64, 1 << 20


def normal(text: bytes) -> str:
    return b" ".join(text.translate(LOWER).split()).decode("utf-8", "replace")


def budget(m: int, rate: float) -> int:
    return int(rate * m)


def split(item: str, rate: float) -> list[tuple[int, int]]:
    """(from, to) of edits + 1 pieces of nearly equal length."""
    n = budget(len(item), rate) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return list(zip(cuts, cuts[1:]))


class Patterns:
    """Match masks of texts to search for, in words of 64 bits, beside each other in one array."""

    def __init__(self, texts: list[str], alphabet: np.ndarray) -> None:
        self.alphabet = alphabet
        self.m = np.array([len(t) for t in texts], np.int64)
        self.words = -(-self.m // 64)
        sizes = self.words * (len(alphabet) + 1)
        self.at = np.cumsum(sizes) - sizes
        self.masks = np.zeros(int(sizes.sum()), np.uint64)
        for t, at, words in zip(texts, self.at, self.words):
            i = np.arange(len(t))
            np.bitwise_or.at(self.masks, at + coded(t, alphabet) * words + i // 64, np.uint64(1) << (i % 64).astype(np.uint64))

    def nearest(self, which: np.ndarray, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least edit distance of each pattern in which to any part of its stretch of codes, and where the first such part ends."""
        best, end = self.m[which].copy(), start.copy()
        order = np.lexsort((stop - start, self.words[which]))
        cuts = np.flatnonzero(np.diff(self.words[which][order])) + 1
        for same in np.split(order, cuts):
            at_once = max(1, AT_ONCE * 4 // int(self.words[which[same[0]]])) if len(same) else 1
            for i in range(0, len(same), at_once):
                some = same[i : i + at_once]
                best[some], end[some] = self.myers(which[some], codes, start[some], stop[some])
        return best, end

    def myers(self, which: np.ndarray, codes: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Myers' recurrence for many pairs with the same number of words; bits above a pattern's length never reach those below."""
        m, words, n = self.m[which], int(self.words[which[0]]), len(which)
        one, top = np.uint64(1), np.uint64(63)
        pv, mv = np.full((words, n), np.uint64(2**64 - 1)), np.zeros((words, n), np.uint64)
        bit, base, length = ((m - 1) % 64).astype(np.uint64), self.at[which], stop - start
        score, best, end = m.copy(), m.copy(), np.zeros(n, np.int64)
        for t in range(int(length.max(initial=0))):
            at = base + codes[np.minimum(start + t, len(codes) - 1)] * words
            ph_in, mh_in = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            for w in range(words):
                eq, p, q = self.masks[at + w], pv[w], mv[w]
                xv = eq | q
                eq = eq | mh_in  # a decrease from the word below acts as a match in bit 0
                xh = (((eq & p) + p) ^ p) | eq
                ph, mh = q | ~(xh | p), p & xh
                if w == words - 1:
                    score += ((ph >> bit) & one).astype(np.int64) - ((mh >> bit) & one).astype(np.int64)
                ph_out, mh_out = ph >> top, mh >> top
                ph, mh = (ph << one) | ph_in, (mh << one) | mh_in
                pv[w], mv[w] = mh | ~(xv | ph), ph & xv
                ph_in, mh_in = ph_out, mh_out
            better = (score < best) & (t < length)
            best, end = np.where(better, score, best), np.where(better, t + 1, end)
        return best, start + end


def letters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def coded(text: str, alphabet: np.ndarray) -> np.ndarray:
    """1 and up for the characters of the alphabet, 0 for others."""
    x = letters(text)
    code = np.minimum(np.searchsorted(alphabet, x), len(alphabet) - 1)
    return np.where(alphabet[code] == x, code + 1, 0)


def merged(owner: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of an owner that overlap or are at most GAP apart, as one."""
    order = np.lexsort((low, owner))
    owner, low, high = owner[order], low[order], high[order]
    if not len(owner):
        return owner, low, high
    rank = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]])) * (int(high.max() - low.min()) + GAP + 2)
    so_far = np.maximum.accumulate(high + rank)
    new = np.concatenate([[True], low[1:] + rank[1:] > so_far[:-1] + GAP])
    start = np.flatnonzero(new)
    return owner[start], low[start], np.maximum.reduceat(high, start)


def cut_in_lanes(low: np.ndarray, high: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of span places, and the stretch of each."""
    n = (high - low) // span + 1
    which = np.repeat(np.arange(len(low)), n)
    begin = low[which] + span[which] * (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n))
    return which, begin, np.minimum(begin + span[which] - 1, high[which])


class Matcher:
    """The automaton over all pieces, and the items and groups of pieces that hits are verified against."""

    def __init__(self, items: list[str], rate: float) -> None:
        import ahocorasick

        self.m = np.array([len(t) for t in items], np.int64)
        self.k = np.array([budget(len(t), rate) for t in items], np.int64)
        self.overlap = int((self.m + self.k).max(initial=0))
        self.machine = ahocorasick.Automaton()
        where: dict[str, list[tuple[int, int]]] = {}
        groups: list[tuple[int, int, int, int]] = []  # item, from, to, budget
        for i, item in enumerate(items):
            pieces = split(item, rate)
            for own in np.array_split(np.array(pieces), -(-len(pieces) // GROUP)):
                groups.append((i, int(own[0, 0]), int(own[-1, 1]), len(own) - 1))
                for a, b in own.tolist():
                    where.setdefault(item[a:b], []).append((len(groups) - 1, b - 1))  # where in the item the piece ends
        for i, piece in enumerate(where):
            self.machine.add_word(piece, i)
        if where:
            self.machine.make_automaton()
        # Of each piece: the groups that hold it, one after another.
        self.held = np.array([len(x) for x in where.values()], np.int64)
        self.holds_from = np.cumsum(self.held) - self.held
        self.group_of, self.ends_at = np.array([y for x in where.values() for y in x], np.int64).reshape(-1, 2).T
        self.groups = np.array(groups, np.int64).reshape(-1, 4)
        self.alphabet = np.unique(np.concatenate([letters(t) for t in items] or [letters(" ")]))
        self.whole = Patterns(items, self.alphabet)
        self.part = Patterns([items[i][a:b] for i, a, b, _ in groups], self.alphabet)

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, distance, end in the text) of stretches that hold an item within its budget; the best of each item is among them.

        Of the groups that make up an item, one must occur within its own budget, one edit less than it has pieces: otherwise
        the edits of all groups together would exceed the item's budget. Whole items are verified where one does.
        """
        out, some, size = [], [], 0
        for d, text in enumerate(texts):
            for at in range(0, max(1, len(text) - self.overlap), PART):
                part = text[at : at + PART + self.overlap]
                if some and size + len(part) > PART:
                    out += self.search_parts(some)
                    some, size = [], 0
                some.append((d, at, part))
                size += len(part)
        return out + self.search_parts(some)

    def search_parts(self, parts: list[tuple[int, int, str]]) -> list[tuple[int, int, int, int]]:
        pieces, size = len(self.held), np.array([len(t) for *_, t in parts], np.int64)
        base = np.cumsum(size) - size
        # A hit as one number: the part, the piece and where it ends.
        hits = [np.fromiter((p * length + end for end, p in self.machine.iter(t)), np.int64) + d * pieces * length for d, (t, length) in enumerate((t, max(1, int(size.max()))) for *_, t in parts)] if pieces else []
        hits = np.sort(np.concatenate([h for h in hits if len(h)] or [np.zeros(0, np.int64)]))
        if not len(hits):
            return []
        longest = max(1, int(size.max()))
        owner, end = np.divmod(hits, longest)
        new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (end[1:] - end[:-1] > GAP)])
        start = np.flatnonzero(new)
        low, high = end[start], end[np.append(start[1:], len(end)) - 1]
        d, piece = np.divmod(owner[start], pieces)
        codes = np.concatenate([coded(t, self.alphabet) for *_, t in parts])
        n, out = self.held[piece], []
        cuts = np.searchsorted(np.cumsum(n), np.arange(0, int(n.sum()), EXPANDED), side="left")
        for a, b in zip(cuts, [*cuts[1:], len(n)]):
            if b > a:
                out += self.verified(parts, base, size, codes, d[a:b], piece[a:b], low[a:b], high[a:b])
        return out

    def verified(self, parts, base, size, codes, d, piece, low, high) -> list[tuple[int, int, int, int]]:
        """What search returns, for the runs of hits of pieces in parts d."""
        n = self.held[piece]
        run = np.repeat(np.arange(len(n)), n)
        held = np.arange(len(run)) + np.repeat(self.holds_from[piece] - (np.cumsum(n) - n), n)
        group, shift = self.group_of[held], self.ends_at[held]
        many = len(self.groups)
        owner, low, high = merged(d[run] * many + group, low[run] - shift, high[run] - shift)  # where the item would start
        group = owner % many
        _, a, b, k = self.groups[group].T
        which, low, high = cut_in_lanes(low, high, np.maximum(GAP, b - a))
        owner, group, a, b, k = owner[which], group[which], a[which], b[which], k[which]
        d = owner // many
        first, last = base[d], base[d] + size[d]
        best, _ = self.part.nearest(group, codes, np.clip(first + low + a - k, first, last), np.clip(first + high + b + k, first, last))
        ok = best <= k
        item = self.groups[group[ok], 0]
        owner, low, high = merged(d[ok] * len(self.m) + item, low[ok], high[ok])
        which, low, high = cut_in_lanes(low, high, np.maximum(GAP, self.m[owner % len(self.m)]))
        d, item = np.divmod(owner[which], len(self.m))
        first, last, k = base[d], base[d] + size[d], self.k[item]
        best, end = self.whole.nearest(item, codes, np.clip(first + low - k, first, last), np.clip(first + high + self.m[item] + k, first, last))
        ok = best <= k
        return [(parts[x][0], i, e, at + parts[x][1]) for x, i, e, at in zip(d[ok].tolist(), item[ok].tolist(), best[ok].tolist(), (end - first)[ok].tolist())]


def blocks(items: list[tuple[int, str]], most: int = BLOCK_CHARS) -> list[list[tuple[int, str]]]:
    out, size = [[]], 0
    for x in items:
        if size + len(x[1]) > most and out[-1]:
            out, size = [*out, []], 0
        out[-1].append(x)
        size += len(x[1])
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, row (of the document in its read), item_id, item_chars, distance, end_char: the best match of each item that a document holds.

    end_char is where it ends in the normalised text.
    """
    rows = id_text(docs, id_col, text_col).select("doc_id", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"))
    return reduce(DataFrame.union, [matches(rows, b, rate) for b in blocks(query_set(benchmark, item_col, text_col))])


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """The rows, with all their columns, that hold no item."""
    if not 0 <= rate < 1:
        raise ValueError("rate is a share of an item's characters")
    for items in blocks(query_set(benchmark, item_col, "text")):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def start(sent=sent):
            matcher = Matcher(sorted({t for _, t in sent.value}), rate)

            def keep(texts: list[bytes]) -> np.ndarray:
                out = np.ones(len(texts), bool)
                out[[x[0] for x in matcher.search([normal(t) for t in texts])]] = False
                return out

            return keep

        docs = keep_rows(docs, text_col, start) if items else docs
    return docs


def query_set(benchmark: DataFrame, item_col: str, text_col: str) -> list[tuple[int, str]]:
    """The normalised items, which the driver sends out as the stated query set."""
    items = id_text(benchmark, item_col, text_col).distinct()
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if chars > MOST_CHARS:
        raise ValueError(f"the benchmark has {chars} characters; a query set of at most {MOST_CHARS} is sent to the tasks")
    return sorted({(r[0], t) for r in items.toLocalIterator() if (t := normal(r[1].encode()))}, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def matches(rows: DataFrame, items: list[tuple[int, str]], rate: float) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(items)
    names = ["doc_id", "row", "item_id", "item_chars", "distance", "end_char"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of: dict[str, list[int]] = {}
        for i, t in sent.value:
            ids_of.setdefault(t, []).append(i)
        texts_of = list(ids_of)
        matcher = Matcher(texts_of, rate)
        for batch in batches if texts_of else ():
            ids, row = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for at, texts in byte_chunks(batch.column(1)):
                best: dict[tuple[int, int], tuple[int, int]] = {}
                for doc, item, d, end in matcher.search([normal(t) for t in texts]):
                    best[doc, item] = min(best.get((doc, item), (d, end)), (d, end))
                found = [(ids[at + doc], row[at + doc], i, len(texts_of[item]), *best[doc, item]) for doc, item in sorted(best) for i in ids_of[texts_of[item]]]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    return rows.mapInArrow(run, "doc_id long, row long, item_id long, item_chars int, distance int, end_char int")
