"""Language-model scoring by online logistic context mixing.

A byte is coded by binary decisions down a Huffman tree, one of CLASSES by the byte before (an end mark included). For each
decision, predictors for the last two, three and four bytes and for the word so far (at its beginning, the word before)
look up what the training corpus decided in their context; words are hashed. Their stretched probabilities, weighted, are added
and squashed; a gate, how far down the tree the decision is and which of the two longest contexts the corpus knows, selects the
weights. Weights start alike for each document and are refined online, after every BLOCK bytes, by the gradient of the
coding cost; so given the corpus' counts and start weights, a score doesn't depend on the documents beside it. The text's
log10 probability is minus its total bits, times log10(2).

What is gathered from the corpus grows with it and is never sent whole to a task. It is exchanged as compressed lists:

1. Rows are dealt into blocks of about BLOCK_BYTES, stored with their texts. Each block lists its distinct (context, byte) pairs of
   each predictor, with their counts in its training texts, and its distinct tokens likewise, sorted and cut into ranges.
2. An owner of a range adds up the lists of all blocks. It answers each block with the stretched probabilities on the path
   to each byte that the block asked for (one number where they are all the same), or with the tokens' counts, in the order of
   the block's own list.
3. A block's answers meet its texts, which are then scored.

Ranges follow the corpus' size (OWNER_BYTES of text each), so an owner's memory doesn't grow with it. A context that all
blocks hold costs its owner one entry a block. Lists have blocks times ranges as their number, so it grows with the square of the
corpus; beyond some hundred GB larger blocks and owners keep the lists long (both are parameters).

The weights that documents start with are learnt from the training corpus too. Every block codes its
texts of the training fold TUNE with the counts of its other training texts, while it lists its pairs; an owner averages the
blocks' mean weights and answers each block with them.

Base score: sum over tokens of log10((c + 1) / (N + V + 1)). Tokens are words, A-Z lower-cased, and one end a text. They are
compared whole. Null and empty texts hold the end only. Without training texts, N and V are 0, every c is 0, and each decision has
probability one half. Repeated rows give repeated results.
"""
from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, fold, id_text, stored

#: 0xFF is in no UTF-8 text: it stands for the end.
END = 255
#: Bytes of context of the first predictors, from the longest; the last one takes words. TOKENS is what a list of tokens has in place of a predictor.
ORDERS = (4, 3, 2)
PREDICTORS = TOKENS = len(ORDERS) + 1
#: What a list of start weights has there.
WEIGHTS = TOKENS + 1
#: The word before belongs to contexts of fewer letters than this; bytes of a word that its hash covers; how far back a context reaches at most.
WITH_BEFORE, WORD, REACH = 1, 24, 64
#: Bytes of a block's texts (those of up to 2**22 - 1 are sorted fastest), and of the texts whose pairs one owner adds up, about; fewer owners where lists are short.
BLOCK_BYTES, OWNER_BYTES, FEWER = 3 << 20, 1 << 24, (4, 16, 64, 1, 4)
#: Trees, one for each common byte before (letters in lower case, all white space as one) and one for the rest: 5 bits.
CLASSES = 32
#: Bytes of texts whose contexts are taken at once; keys that are sorted at once.
FEW_BYTES, SORTED = 1 << 15, 1 << 18
#: Bytes between refinements, and texts whose next BLOCK bytes are coded at once: their arrays fit a core's cache.
BLOCK, AT_ONCE, RATE = 256, 48, 0.02
#: A stretched probability is kept in steps of STEP; what is added to counts. GATES: three depths, and which of the two longest contexts are known.
STEP, PRIOR, GATES = np.float32(0.25), 0.1, 12
#: The training fold that teaches the start weights; their rate, and the weights before that.
TUNE, TUNE_RATE = 3, 0.01
FIRST = np.array([0.4, 0.2, 0.1, 0.4], np.float32)
_SPACE = np.zeros(256, bool)
_SPACE[[*range(9, 14), 32, END]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
#: A byte as the choice of a tree sees it; what is before a text counts as white space.
_KIND = _LOW.copy()
_KIND[_SPACE] = _KIND[0] = 32
#: Keeps the last 0 to 8 of eight bytes.
_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Odd, and its inverse: contexts of up to four bytes, spread evenly over 32 bits.
_SPREAD, _BACK, _32 = np.uint64(0x9E3779B1), np.uint64(pow(0x9E3779B1, -1, 1 << 32)), np.uint64(2**32 - 1)
#: Values of a path that are looked up as one number.
HEAD = 8
#: Bytes from a token's beginning that choose its owner, besides its last ones.
HASHED = 512
#: A pair given for a place of a list whose path has several values.
SEVERAL = -128


def spaces(s: np.ndarray) -> np.ndarray:
    """Whether bytes are white space or an end."""
    return (s - 9 <= 4) | (s == 32) | (s == END)


def lowered(s: np.ndarray) -> np.ndarray:
    return s + ((s - 65 < 26).view(np.uint8) << 5)


def mixed(x: np.ndarray) -> np.ndarray:
    """32 bits of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x >>= np.uint64(32)
    return x


def eight(s: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Of each place: the eight bytes before it, within its text, as one number, the latest lowest."""
    padded = np.concatenate([np.zeros(8, np.uint8), s])
    out = np.ndarray(len(s), ">u8", padded.data, strides=(1,)).astype("<u8")
    for k in range(8):
        at = first[size > k] + k
        out[at] &= _KEEP[k]
    return out


def huffman(counts: np.ndarray) -> list[list[tuple[int, int]]]:
    """(node, bit) pairs from the root down to each of 256 bytes. Every byte has a code."""
    heap = [(int(c) * 512 + 1, i, i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    children, n = {}, 256
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        children[n] = (a[2], b[2])
        heapq.heappush(heap, (a[0] + b[0], n, n))
        n += 1
    codes: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    stack = [(heap[0][2], [])]
    while stack:
        node, path = stack.pop()
        if node < 256:
            codes[node] = path
        else:
            stack += [(child, [*path, (node - 256, bit)]) for bit, child in enumerate(children[node])]
    return codes


@dataclass
class Forest:
    """The tree that each byte before selects, and by tree and byte (tree * 256 + byte) the path: its length, and start in one list of nodes and bits."""

    tree: np.ndarray
    length: np.ndarray
    start: np.ndarray
    node: np.ndarray
    bit: np.ndarray

    def __post_init__(self) -> None:
        self.side = self.node << 1 | self.bit

    @classmethod
    def of(cls, counts: np.ndarray) -> Forest:
        """counts: how often each byte follows each _KIND of byte, 256 * 256."""
        counts = counts.reshape(256, 256)
        common = np.argsort(-counts.sum(axis=1), kind="stable")[: CLASSES - 1]
        tree = np.full(256, CLASSES - 1, np.int64)
        tree[common] = np.arange(CLASSES - 1)
        codes = [c for i in range(CLASSES) for c in huffman(counts[tree == i].sum(axis=0))]
        length = np.array([len(c) for c in codes])
        return cls(tree[_KIND], length, np.cumsum(length) - length, np.array([n for c in codes for n, _ in c]), np.array([b for c in codes for _, b in c]))

    def codes(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """tree * 256 + byte of a predictor's pairs."""
        context = keys >> np.uint64(8)
        tree = context & np.uint64(31) if kind == PREDICTORS - 1 else self.tree[((context * _BACK) & np.uint64(255)).astype(np.int64)]
        return tree.astype(np.int64) << 8 | (keys & np.uint64(255)).astype(np.int64)


@dataclass
class Segment:
    """Consecutive texts, each with its end; or, with lead bytes before it that only serve as context, a part of a long one."""

    symbols: np.ndarray
    first: np.ndarray
    size: np.ndarray
    lead: int = 0

    def codes(self, forest: Forest) -> np.ndarray:
        """tree * 256 + byte of each place but the lead."""
        before = np.concatenate([np.zeros(1, np.uint8), self.symbols[:-1]])
        before[self.first] = 0
        return (forest.tree.take(before) << 8 | self.symbols)[self.lead :]

    def by_few(self, keys: Callable[[Segment], np.ndarray]) -> np.ndarray:
        """keys of all places, taken from a few texts at a time, whose arrays stay in a core's cache."""
        ends = self.first + self.size
        out, at = np.empty(len(self.symbols), np.uint64), 0
        while at < len(ends):
            a = int(self.first[at])
            to = max(at + 1, int(np.searchsorted(ends, a + FEW_BYTES, side="right")))
            b = int(ends[to - 1])
            out[a:b] = keys(Segment(self.symbols[a:b], self.first[at:to] - a, self.size[at:to]))
            at = to
        return out

    def strings(self) -> np.ndarray:
        """The longest context of bytes and the byte, 40 bits, of each place but the lead. Shorter ones are its low bytes."""
        if len(self.size) > 1 and len(self.symbols) > FEW_BYTES:
            return self.by_few(lambda few: few.strings())
        before = eight(self.symbols, self.first, self.size)
        before <<= np.uint64(8)
        before &= np.uint64(2**40 - 1)
        before |= self.symbols
        return before[self.lead :]

    def word_pairs(self, forest: Forest) -> np.ndarray:
        """The word's hash (29 bits), the tree and the byte of each place but the lead."""
        if len(self.size) > 1 and len(self.symbols) > FEW_BYTES:
            return self.by_few(lambda few: few.word_pairs(forest))
        s, first = self.symbols, self.first
        low = eight(lowered(s), first, self.size)
        begin = np.arange(1, len(s) + 1, dtype=np.int32)
        begin *= spaces(s)
        begin = np.concatenate([np.zeros(1, np.int32), np.maximum.accumulate(begin)[:-1]])  # where the word that a place goes on begins
        n = np.arange(len(s), dtype=np.int32) - begin
        word = mixed(low & _KEEP.take(np.minimum(n, 8)))
        for k in range(8, WORD, 8):
            more = np.flatnonzero(n > k)
            word[more] += mixed((low[more - k] & _KEEP[np.minimum(n[more] - k, 8)]) + np.uint64(k))
        del low
        word += np.minimum(n, WORD).astype(np.uint64)
        early = np.flatnonzero((n < WITH_BEFORE) & (begin > 0))
        last = word[begin[early] - 1]
        begins = np.zeros(len(s), bool)
        begins[first] = True
        last[begins[begin[early]]] = 0  # a text's first word has none before it
        word[early] += last * np.uint64(0xC2B2AE3D27D4EB4F)
        del begin, n
        word = mixed(word[self.lead :])
        word >>= np.uint64(3)
        word <<= np.uint64(13)
        word |= self.codes(forest).view(np.uint64)
        return word


def segments(texts: list[bytes], most: int = BLOCK_BYTES) -> Iterator[Segment]:
    """All texts as one segment; a single text of more than `most` bytes in several."""
    s = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    size = np.array([len(t) + 1 for t in texts], np.int64)
    if len(texts) > 1 or len(s) <= most:
        yield Segment(s, np.cumsum(size) - size, size)
        return
    for at in range(0, len(s), most):
        lead = min(at, REACH)
        part = s[at - lead : at + most]
        yield Segment(part, np.zeros(1, np.int64), np.array([len(part)]), lead)


def spread(strings: np.ndarray) -> np.ndarray:
    """Pairs of strings of bytes, their contexts spread over 32 bits."""
    return (((strings >> np.uint64(8)) * _SPREAD) & _32) << np.uint64(8) | (strings & np.uint64(255))


def shorter(strings: np.ndarray, order: int) -> np.ndarray:
    return strings & np.uint64((1 << (8 * order + 8)) - 1)


def distinct(keys: np.ndarray, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys of 42 bits, and the place of each key among them: keys are sorted with their places in the low 22 bits, where these hold them.
    Many keys are sorted part by part first."""
    if len(keys) > SORTED and not whole:
        parts = [distinct(keys[i : i + SORTED]) for i in range(0, len(keys), SORTED)]
        u, place = distinct(np.concatenate([own for own, _ in parts]), True)
        out, at = np.empty(len(keys), np.int32), 0
        for i, (own, of) in enumerate(parts):
            place[at : at + len(own)].take(of, out=out[i * SORTED : (i + 1) * SORTED], mode="clip")
            at += len(own)
        return u, out
    if len(keys) > 1 << 22:
        u, place = np.unique(keys, return_inverse=True)
        return u, place.astype(np.int32)
    both = keys << np.uint64(22)
    both |= np.arange(len(keys), dtype=np.uint64)
    both.sort()
    at = (both & np.uint64((1 << 22) - 1)).view(np.int64)
    both >>= np.uint64(22)
    new = np.ones(len(keys), bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    place = np.empty(len(keys), np.int32)
    place[at] = np.cumsum(new, dtype=np.int32) - 1
    return both[new], place


def tallied(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and how often each is there."""
    keys.sort()
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.diff(np.append(new, len(keys)))


def added(keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """The distinct keys, and the sums of each one's counts."""
    if not (keys[1:] >= keys[:-1]).all():
        order = np.argsort(keys)
        keys, counts = keys[order], [n[order] for n in counts]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[new], *(np.add.reduceat(n, new) if len(new) else n for n in counts)]


def merged(lists: list[np.ndarray], n: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The distinct keys of lists, the sums of their counts, and each list's places among them."""
    keys, place = distinct(np.concatenate(lists), True)
    return keys, np.bincount(place, n).astype(np.int64), np.split(place, np.cumsum([len(x) for x in lists])[:-1])  # whole numbers under 2**53


def pair_counts(texts: list[bytes], roles: np.ndarray, forest: Forest) -> Iterator[list[np.ndarray]]:
    """Of each predictor: the distinct pairs of the texts, and their counts in texts to train on (roles 1 and 2) and to tune by (role 2)."""
    found: list[list] = [[], []]
    for segment in segments(texts) if texts else ():
        role = np.repeat(roles.astype(np.uint8), segment.size - segment.lead) if len(roles) > 1 else np.uint64(roles[0])
        for own, make in zip(found, (segment.strings, lambda: segment.word_pairs(forest))):
            keys = make()
            keys <<= np.uint64(2)
            keys |= role
            both, n = tallied(keys)
            role_of = both & np.uint64(3)
            own.append((both >> np.uint64(2), n * (role_of > 0), n * (role_of == 2)))
    strings, words = (added(*(np.concatenate(x) for x in zip(*own))) if own else [np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 2] for own in found)
    for order in ORDERS:
        yield added(spread(shorter(strings[0], order)), *strings[1:])
    yield words


@dataclass
class Values:
    """The stretched probability of each decision that leads to a pair's byte: one for all of them, or SEVERAL and where they begin."""

    flags: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    several: np.ndarray

    @classmethod
    def of(cls, kind: int, keys: np.ndarray, n: np.ndarray, forest: Forest, at_once: int = 1 << 14) -> Values:
        """Of sorted distinct pairs with all of their contexts' counts."""
        context = keys >> np.uint64(8)
        new = np.concatenate([[True], context[1:] != context[:-1]]) if len(keys) else np.zeros(0, bool)
        of = np.cumsum(new) - 1
        total = np.bincount(of, n)[of] if len(keys) else n
        # A pair that all of its context's counts go to, be they none: every decision has the same counts.
        plain = n == total
        flags = np.where(plain, stretched(np.zeros(len(n)), n), SEVERAL).astype(np.int8)
        mixed_context = np.bincount(of, ~plain, minlength=1)[of] > 0 if len(keys) else plain
        code = forest.codes(kind, keys)
        length = np.where(plain, 0, forest.length[code])
        out, some = [], np.flatnonzero(mixed_context)
        begins = np.flatnonzero(np.diff(of[some])) + 1
        at = 0
        while at < len(some):
            i = np.searchsorted(begins, at + at_once)
            to = int(begins[i]) if i < len(begins) else len(some)
            part = some[at:to]
            at = to
            start, paths = forest.start.take(code.take(part)), forest.length.take(code.take(part))
            place = np.repeat(start - (np.cumsum(paths) - paths), paths)
            place += np.arange(len(place))
            # A side: the context, the node and the way that the decision falls. The other side of a node is beside it.
            side = np.repeat((of.take(part) - of[part[0]]) << 9, paths)
            side |= forest.side.take(place)
            sides, side = distinct(side.view(np.uint64), True)
            taken = np.bincount(side, np.repeat(n.take(part).astype(float), paths))
            both = np.flatnonzero(sides[1:] >> np.uint64(1) == sides[:-1] >> np.uint64(1))
            missed = np.zeros(len(taken))
            missed[both], missed[both + 1] = taken[both + 1], taken[both]
            value = stretched(missed, taken).take(side)
            out.append(value if not plain.take(part).any() else value[np.repeat(~plain.take(part), paths)])
        return cls(flags, np.cumsum(length) - length, length, np.concatenate(out) if out else np.zeros(0, np.int8))

    def at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Flags, and the values of those that have several."""
        n = self.length[places]
        return self.flags[places], self.several[np.repeat(self.begin[places] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Of how often a decision fell each way: in steps of STEP; 0 without counts."""
    odds = np.log(((ones + PRIOR) / (zeros + PRIOR)).astype(np.float32))
    return np.rint(np.clip(odds, -8.8, 8.8) / STEP).astype(np.int8)


def packed(*arrays: np.ndarray) -> bytes:
    """Compressed planes of bytes, the lowest first, of arrays of equal length; planes of zeros at the end are left out."""
    used = [(int(a.max(initial=0)).bit_length() + 7) // 8 for a in arrays]
    return bytes(used) + squeezed(b"".join((a >> a.dtype.type(8 * i)).astype(np.uint8).tobytes() for a, u in zip(arrays, used) for i in range(u)))


def unpacked(data: bytes, arrays: int, n: int) -> list[np.ndarray]:
    """n: length of each array."""
    raw, out, at = np.frombuffer(opened(data[arrays:]), np.uint8), [], 0
    for used in data[:arrays]:
        x = np.zeros(n, np.uint64)
        for i in range(used):
            x |= raw[at : at + n].astype(np.uint64) << np.uint64(8 * i)
            at += n
        out.append(x)
    return out


def squeezed(data: bytes, level: int = 1) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(data)


def opened(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def tokens(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct tokens in order, a line each, the place of each text's tokens among them, and how many each text has. The end is the empty line, the first."""
    s = np.frombuffer(b"".join(t + b"\xff" for t in texts), np.uint8)
    space = spaces(s)
    again = space & np.concatenate([[True], space[:-1]])  # white space that no token is before
    low = np.where(space, np.uint8(10), lowered(s))
    stops = np.flatnonzero(space & ~again)
    n = np.diff(np.searchsorted(stops, np.cumsum([len(t) + 1 for t in texts])), prepend=0) + 1
    coded = lines(low[~again]).dictionary_encode()
    # By their first five bytes, so that those alike are stored beside each other.
    data, begin, size = parts_of(coded.dictionary)
    order = np.argsort((heads(data, begin) & _KEEP.take(np.minimum(size, 5))).byteswap(), kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    every = np.zeros(int(n.sum()), np.int64)
    inside = np.ones(len(every), bool)
    inside[np.cumsum(n) - 1] = False  # the end comes last
    every[inside] = rank[coded.indices.to_numpy(zero_copy_only=False)]
    return pa.concat_arrays([pa.array([b"\n"], pa.large_binary()), coded.dictionary.take(pa.array(order))]), every, n


def parts_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words, some zeros after them, and where each one begins and its size."""
    ends = np.frombuffer(words.buffers()[1] or bytes(8), np.int64)[: len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.int8)[: ends[-1]]
    return np.concatenate([data, np.zeros(24, np.int8)]), ends[:-1], np.diff(ends)


def lines(data: np.ndarray) -> pa.Array:
    """The lines of bytes, each with its end."""
    ends = np.flatnonzero(data == 10) + 1
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate([np.zeros(1, np.int64), ends])), pa.py_buffer(data)])


def heads(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The HEAD values from each begin on, as one number; values has 16 more at its end."""
    words = values[: len(values) // 8 * 8].view("<u8")
    at, shift = begin >> 3, (begin & 7).astype(np.uint64) << np.uint64(3)
    out = words.take(at)
    out >>= shift
    more = words.take(at + 1)
    more <<= np.uint64(63) - shift  # in two steps, as a shift by 64 isn't defined
    more <<= np.uint64(1)
    out |= more
    return out


class Coder:
    """Codes texts by the flags and values that were answered for their pairs."""

    def __init__(self, forest: Forest, texts: list[bytes], answers: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.forest, self.texts, self.answers = forest, texts, answers
        self.segments = list(segments(texts))
        # Of the whole text, where several segments share its pairs.
        self.pairs = [k for k, *_ in pair_counts(texts, np.zeros(len(texts), np.uint64), forest)] if len(self.segments) > 1 else []
        self.values: list[np.ndarray] = []
        self.begins: list[np.ndarray] = []
        self.heads: list[np.ndarray] = []
        self.length = forest.length.astype(np.int16)
        self.rooms: dict[str, np.ndarray] = {}

    def rows(self, kind: int, keys: np.ndarray) -> np.ndarray:
        """Where in the predictor's tables each of the segment's sorted distinct pairs has its own."""
        every = self.pairs[kind] if self.pairs else keys
        if len(self.values) == kind:
            flags, several = self.answers[kind]
            length = self.length.take(self.forest.codes(kind, every))
            differ = flags == SEVERAL
            some, alike = np.flatnonzero(differ), np.flatnonzero((length > HEAD) & ~differ)
            # The values of each pair that has several; and, to be looked up beyond the heads, those of long paths that have one.
            own = np.concatenate([some, alike])
            n = length.take(own).astype(np.int64)
            begin = np.zeros(len(every), np.int32)
            begin[own] = np.cumsum(n) - n
            values = np.concatenate([several, np.repeat(flags.take(alike), length.take(alike)), np.zeros(16, np.int8)])
            head = flags.view(np.uint8).astype(np.uint64) * np.uint64(0x0101010101010101)
            head[some] = heads(values, begin.take(some).astype(np.int64))
            self.values.append(values)
            self.begins.append(begin)
            self.heads.append(head)
        return np.searchsorted(every, keys).astype(np.int32) if self.pairs else np.arange(len(keys), dtype=np.int32)

    def places(self, segment: Segment) -> list[np.ndarray]:
        """Of each place: the numbers of its string and of its word pair. Keeps what the predictors' tables hold for these, for a string side by side."""
        strings, string = distinct(segment.strings())
        self.of_string, self.tail = np.zeros((len(strings), PREDICTORS), np.uint64), []  # the word's head goes last
        for kind, order in enumerate(ORDERS):
            own, of = distinct(spread(shorter(strings, order)))
            row = self.rows(kind, own)[of]
            self.of_string[:, kind] = self.heads[kind].take(row)
            self.tail.append(self.begins[kind].take(row))
        code = self.forest.tree.take((strings >> np.uint64(8) & np.uint64(255)).view(np.int64)) << 8
        self.long = self.length.take(code | (strings & np.uint64(255)).view(np.int64))  # of the path to a string's byte
        own, word = distinct(segment.word_pairs(self.forest))
        row = self.rows(PREDICTORS - 1, own)
        self.of_word = self.heads[-1].take(row) if self.pairs else self.heads[-1]
        self.tail.append(self.begins[-1].take(row) if self.pairs else self.begins[-1])
        return [string, word]

    def bits(self, start: np.ndarray, learn: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Total bits of each text, its end included, and the mean of the weights while learning.

        Each text refines its own copy of the start weights; or, to learn, all texts the same ones.
        """
        out, weights = np.zeros(len(self.texts)), np.array(start).reshape(1, 3, 4, PREDICTORS).astype(np.float32)
        self.trace, self.steps = np.zeros((GATES, PREDICTORS)), 0
        for segment in self.segments:
            size = segment.size - segment.lead
            places = self.places(segment)
            if learn:
                own = weights.reshape(1, GATES, PREDICTORS)
            else:
                own = weights if len(self.segments) > 1 else np.repeat(weights, len(size), axis=0)
            live = np.argsort(-size, kind="stable")
            for at in range(0, int(size.max(initial=0)), BLOCK):
                live = live[size[live] > at]
                for some in (live[i : i + AT_ONCE] for i in range(0, len(live), AT_ONCE)):
                    self.block(some, np.minimum(size[some] - at, BLOCK), segment.first[some] + at, places, own, out, learn)
        return out, self.trace / self.steps if self.steps else start

    def room(self, name: str, kind: type, *shape: int) -> np.ndarray:
        """Space that is used again from block to block, so that it stays in the core's cache."""
        size = math.prod(shape)
        if len(self.rooms.get(name, ())) < size:
            self.rooms[name] = np.empty(size + size // 4, kind)
        return self.rooms[name][:size].reshape(shape)

    def block(self, some, n, begin, places, weights, out, learn) -> None:
        """Codes the next n bytes of some texts, then refines their weights.

        Bytes are ordered by text and known contexts, and their decisions by depth before that: those that share weights are beside each other.
        """
        where = np.repeat(begin - (np.cumsum(n) - n), n)
        where += np.arange(len(where))
        pair = [p.take(where) for p in places]
        found = self.of_string.take(pair[0], axis=0)  # HEAD values of each predictor of each place
        found[:, -1] = self.of_word.take(pair[1])
        found = found.view(np.int8).ravel()
        key = np.repeat(np.arange(0, 4 * len(some), 4, dtype=np.uint8) * np.uint8(not learn), n)  # under 4 * AT_ONCE
        key += found[:: HEAD * PREDICTORS] != 0
        key += (found[HEAD * (PREDICTORS - 1) :: HEAD * PREDICTORS] != 0).view(np.uint8) << 1
        order = np.argsort(key, kind="stable")
        key = key.take(order)
        length = self.long.take(pair[0].take(order))
        runs = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        second, deep = np.flatnonzero(length > 1), np.maximum(length - 2, 0).astype(np.int64)
        rest_from = np.cumsum(deep) - deep
        # Of each set of weights: how many decisions are its own, at each depth.
        runs = np.append(runs, len(key))
        many = np.concatenate([np.diff(runs), np.diff(np.searchsorted(second, runs)), np.diff(np.append(rest_from, rest_from[-1] + deep[-1]).take(runs))])
        runs = runs[:-1]
        sets = 4 * len(some) if not learn else 4
        of = key[runs].astype(np.int64)
        which = np.concatenate([of, sets + of, 2 * sets + of])[many > 0]
        many = many[many > 0]
        starts = np.cumsum(many) - many
        a, b, whole = len(key), len(key) + len(second), int(many.sum())
        at, seen = self.room("at", np.int64, whole), self.room("seen", np.int8, whole)
        x, z, more = self.room("x", np.float32, PREDICTORS, whole), self.room("z", np.float32, whole), self.room("more", np.float32, whole)
        # Where each decision's value is among the heads; that of one beyond them is looked up by itself.
        place = order * (HEAD * PREDICTORS)
        at[:a] = place
        place.take(second, out=at[a:b], mode="clip")
        at[a:b] += 1
        place -= rest_from - 2
        np.add(np.repeat(place, deep), np.arange(whole - b), out=at[b:])
        beyond = np.flatnonzero(length > HEAD)
        if len(beyond):
            over = length.take(beyond) - HEAD
            depth = np.arange(int(over.sum())) - np.repeat(np.cumsum(over) - over, over) + HEAD
            to, who = b + np.repeat(rest_from.take(beyond), over) + depth - 2, np.repeat(order.take(beyond), over)
            who = [p.take(who) for p in pair]
        every = weights[0] if learn else weights[some].transpose(1, 0, 2, 3).reshape(-1, PREDICTORS)  # by depth, text, known contexts
        w = every[which]
        for i in range(PREDICTORS):
            found[HEAD * i :].take(at, out=seen, mode="clip")
            if len(beyond):
                seen[to] = self.values[i].take(self.tail[i].take(who[i == PREDICTORS - 1]) + depth)
            x[i] = seen
            np.multiply(np.repeat(w[:, i], many), x[i], out=more if i else z)
            if i:
                z += more
        z *= -STEP
        np.clip(z, -16, 16, out=z)
        np.exp(z, out=z)
        np.add(z, np.float32(1), out=more)
        z /= more  # the probability of what isn't there
        np.log2(more, out=more)
        if not learn:
            out[some] += np.bincount(which % sets // 4, np.add.reduceat(more.astype(np.float64), starts), len(some))
        x *= z
        step = ((TUNE_RATE if learn else RATE) * STEP / np.sqrt(1 + many)).astype(np.float32)
        every[which] = w + np.add.reduceat(x, starts, axis=1).T * step[:, None]
        if learn:
            self.trace += weights[0]
            self.steps += 1
        else:
            weights[some] = every.reshape(3, len(some), 4, PREDICTORS).transpose(1, 0, 2, 3)


def dealt(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of docs(doc_id, text, role): ids, roles, sizes, the texts, and how often (n) each byte follows each kind (code) in those to train on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at, texts in byte_chunks(batch.column(1), block_bytes):
                roles = batch.column(2).slice(at, len(texts)).to_numpy()
                train = np.frombuffer(b"".join(t + b"\xff" for t, r in zip(texts, roles) if r), np.uint8)
                after = np.concatenate([np.array([END], np.uint8), train[:-1]])[: len(train)]  # the end before a text counts as white space
                n = np.zeros((256, 256), np.int64)
                np.add.at(n, _KIND, np.bincount(after.astype(np.uint16) << 8 | train, minlength=1 << 16).reshape(256, 256))
                n = n.ravel()
                code = np.flatnonzero(n)
                columns = [[block], [batch.column(0).slice(at, len(texts)).to_pylist()], [roles], [[len(t) for t in texts]], [squeezed(b"".join(texts), 3)], [code], [n[code]]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                block += 1

    names = ["block", "ids", "roles", "sizes", "texts", "code", "n"]
    types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return docs.mapInArrow(run, "block long, ids array<long>, roles array<int>, sizes array<long>, texts binary, code array<long>, n array<long>")


def texts_of(sizes: list[int], data: bytes) -> list[bytes]:
    whole = opened(data)
    return [whole[b - n : b] for n, b in zip(sizes, np.cumsum(sizes).tolist())]


def each_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """Block, texts and roles of batches of (block, roles, sizes, texts), one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            block, roles, sizes, data = (c[i].as_py() for c in batch.columns)
            yield block, texts_of(sizes, data), np.array(roles, np.uint64)


def answered(kind: int, keys: np.ndarray, n: np.ndarray, asked: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    """Flags and values of the asked of sorted distinct pairs; contexts that nothing is asked of aren't looked at."""
    context = keys >> np.uint64(8)
    of = np.cumsum(np.concatenate([[False], context[1:] != context[:-1]])[: len(keys)])
    within = (np.bincount(of, asked, minlength=1) > 0)[of] & (asked | (n > 0))
    return Values.of(kind, keys[within], n[within], forest).at(np.flatnonzero(asked[within]))


def owners(kind: int, ranges: int) -> int:
    return -(-ranges // FEWER[kind])


def by_part(words: pa.Array, m: int) -> dict[int, np.ndarray]:
    """The places of the tokens that each of m owners is asked for, by a hash of a token's length, its first HASHED bytes and its last eight."""
    data, begin, n = parts_of(words)
    h = n.astype(np.uint64)
    h += mixed(heads(data, np.maximum(begin, begin + n - 8)) & _KEEP[np.minimum(n, 8)]) * np.uint64(5)
    for k in range(0, min(int(n.max(initial=0)), HASHED), 8):
        more = np.flatnonzero(n > k)
        h[more] += mixed((heads(data, begin[more] + k) & _KEEP[np.minimum(n[more] - k, 8)]) + np.uint64(k))
    part = mixed(h) % np.uint64(m)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    return {int(part[own[0]]): own for own in np.split(order, cuts)}


LIST = "block long, kind int, part long, size long, keys binary, n binary"


def lists_of(blocks: DataFrame, lists) -> DataFrame:
    """The (kind, part, size, keys, n) that lists gives for each block's texts and roles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        for block, texts, roles in each_block(batches):
            columns = zip(*((block, *x) for x in lists(texts, roles)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["block", "kind", "part", "size", "keys", "n"])

    return blocks.select("block", "roles", "sizes", "texts").mapInArrow(run, LIST)


def token_lists(blocks: DataFrame, ranges: int) -> DataFrame:
    def lists(texts: list[bytes], roles: np.ndarray) -> Iterator[tuple]:
        words, every, size = tokens(texts)
        n = np.bincount(every, np.repeat(roles > 0, size), len(words)).astype(np.int64)
        for part, own in by_part(words, owners(TOKENS, ranges)).items():
            yield TOKENS, part, len(own), squeezed(words.take(pa.array(own)).buffers()[2]), packed(n[own])

    return lists_of(blocks, lists)


def listed(texts: list[bytes], roles: np.ndarray, forest: Forest, ranges: int) -> Iterator[tuple]:
    """The lists of a block's pairs; and, as kind WEIGHTS, the mean of the weights while its texts of the fold TUNE are coded, none without such texts."""
    tune, answers = [t for t, r in zip(texts, roles) if r == 2], []
    for kind, (keys, n, less) in enumerate(pair_counts(texts, roles, forest)):
        if tune:
            answers.append(answered(kind, keys, n - less, less > 0, forest))
        context, m = keys >> np.uint64(8), owners(kind, ranges)
        top = context >> np.uint64(2) if kind == PREDICTORS - 1 else context  # its highest 32 bits
        cuts = np.searchsorted(top * np.uint64(m) >> np.uint64(32), np.arange(m + 1))
        for part in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[part], cuts[part + 1]
            yield kind, part, b - a, packed(np.diff(context[a:b], prepend=np.uint64(0)), keys[a:b] & np.uint64(255)), packed(n[a:b])
    mean = Coder(forest, tune, answers).bits(np.tile(FIRST, (GATES, 1)), learn=True)[1] if tune else np.zeros(0)
    yield WEIGHTS, 0, mean.size, mean.astype("<f8").tobytes(), b""


def pair_lists(blocks: DataFrame, forest: Forest, ranges: int) -> DataFrame:
    return lists_of(blocks, lambda texts, roles: listed(texts, roles, forest, ranges))


#: flags of a predictor, counts of tokens, or weights. Sums over a range's tokens are in a row with block -1.
ANSWER = "block long, kind int, part long, size long, flags binary, several binary, total long, known long"
_ANSWER = pa.schema([("block", pa.int64()), ("kind", pa.int32()), ("part", pa.int64()), ("size", pa.int64()), ("flags", pa.binary()), ("several", pa.binary()), ("total", pa.int64()), ("known", pa.int64())])


def token_answers(asked: DataFrame) -> DataFrame:
    def own(key: tuple, t: pa.Table) -> pa.Table:
        part, rows = key[1].as_py(), t.to_pylist()
        code = lines(np.frombuffer(b"".join(opened(r["keys"]) for r in rows), np.uint8)).dictionary_encode().indices.to_numpy(zero_copy_only=False)
        n = np.bincount(code, np.concatenate([unpacked(r["n"], 1, r["size"])[0] for r in rows])).astype(np.int64)  # whole numbers under 2**53
        lists = np.split(code, np.cumsum([r["size"] for r in rows])[:-1])
        out = [(r["block"], TOKENS, part, r["size"], packed(n[places]), None, None, None) for places, r in zip(lists, rows)]
        out.append((-1, TOKENS, part, 0, None, None, int(n.sum()), int((n > 0).sum())))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return asked.groupBy("kind", "part").applyInArrow(own, ANSWER)


def pair_answers(asked: DataFrame, forest: Forest) -> DataFrame:
    def own(key: tuple, t: pa.Table) -> pa.Table:
        kind, part, rows, lists = key[0].as_py(), key[1].as_py(), t.to_pylist(), []
        if kind == WEIGHTS:
            means = [np.frombuffer(r["keys"], "<f8") for r in sorted(rows, key=lambda r: r["block"]) if r["size"]]
            start = (np.mean(means, axis=0) if means else np.tile(FIRST, GATES)).astype("<f8").tobytes()
            out = [(r["block"], kind, part, 0, start, b"", None, None) for r in rows]
            return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)
        for r in rows:
            gaps, symbols = unpacked(r["keys"], 2, r["size"])
            lists.append((np.cumsum(gaps) << np.uint64(8)) | symbols)
        keys, n, places = merged(lists, np.concatenate([unpacked(r["n"], 1, r["size"])[0] for r in rows]).astype(np.int64))
        values, out = Values.of(kind, keys, n, forest), []
        for r, own in zip(rows, places):
            flags, several = values.at(own)
            out.append((r["block"], kind, part, len(own), squeezed(flags.tobytes()), squeezed(several.tobytes()), None, None))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return asked.groupBy("kind", "part").applyInArrow(own, ANSWER)


def scores(docs: DataFrame, folds: int = 7, held_out: int = 2, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES, owner_bytes: int = OWNER_BYTES) -> DataFrame:
    """Trains on the documents outside the held-out fold and scores all: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, n_bytes."""
    of = fold("doc_id", folds)
    role = F.when(of == held_out, 0).when(of == TUNE, 2).otherwise(1)
    blocks = stored(dealt(id_text(docs, id_col, text_col).select("doc_id", "text", role.alias("role")), block_bytes))
    counts = np.zeros(1 << 16, np.int64)
    for code, n in blocks.select(F.explode(F.arrays_zip("code", "n")).alias("x")).groupBy("x.code").agg(F.sum("x.n")).collect():  # at most 65536 rows
        counts[code] = n
    forest = Forest.of(counts)
    n_bytes = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b + 1))).first()[0] or 0
    ranges = -(-n_bytes // owner_bytes) or 1
    of_tokens = stored(token_answers(token_lists(blocks, ranges)))
    total, known = of_tokens.where("block < 0").agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("known"), F.lit(0))).first()
    each = float(np.log10(total + known + 1))

    def run(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: (-1 if r["kind"] is None else r["kind"], r["part"] or 0))
        block, answers = rows[0], rows[1:]
        texts, pairs = texts_of(block["sizes"], block["texts"]), []
        for kind in range(PREDICTORS):
            own = [r for r in answers if r["kind"] == kind]
            pairs.append(tuple(np.frombuffer(b"".join(opened(r[c]) for r in own), np.int8) for c in ("flags", "several")))
        start = next(np.frombuffer(r["flags"], "<f8") for r in answers if r["kind"] == WEIGHTS)
        bits, _ = Coder(forest, texts, pairs).bits(start)
        words, every, size = tokens(texts)
        places, counts = by_part(words, owners(TOKENS, ranges)), np.zeros(len(words), np.int64)
        for r in answers:
            if r["kind"] == TOKENS:
                counts[places[r["part"]]] = unpacked(r["flags"], 1, r["size"])[0]
        whose = np.repeat(np.arange(len(texts)), size)
        logs = np.bincount(whose, np.log10(counts + 1.0)[every], len(texts))
        return pa.table({
            "doc_id": pa.array(block["ids"], pa.int64()), "held_out": [r == 0 for r in block["roles"]], "n_tokens": size, "n_known": np.bincount(whose[counts[every] > 0], minlength=len(texts)),
            "train_tokens": np.full(len(texts), total), "base_score": logs - size * each, "score": -np.log10(2) * bits, "n_bytes": block["sizes"],
        })

    beside = blocks.drop("code", "n").unionByName(of_tokens.where("block >= 0").drop("total", "known"), allowMissingColumns=True)
    beside = beside.unionByName(pair_answers(pair_lists(blocks, forest, ranges), forest).drop("total", "known"), allowMissingColumns=True)
    return beside.groupBy("block").applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, n_bytes long")
