"""Motifs on contigs: one pass over tiles for all motifs, and occurrences without overlap as from the contig's left end.

1. Contigs are cut into tiles that reach into the letters of the next, and dealt out, so a long contig is many tasks.
2. A task walks one automaton for all motifs: its state is the number of the next few letters in the alphabet's base, and each state knows the motifs that
   begin so. All places are walked at once. Motifs of more letters are compared in full at the places that their first ones leave.
3. Occurrences of a motif count from the left, and the next begins behind the last that counted. What a tile does depends on how many of its first letters the
   tile before has used up, so a tile is a function from that number to its own. Only a motif that can overlap itself needs it, and
   only the run of overlapping occurrences at a tile's begin depends on it.
4. The functions are composed along a contig by a scan (a few numbers a tile), and the runs at the begins are settled with its result.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import stored

#: Letters of a tile, and letters that the automaton's states tell apart.
TILE, WALK = 1 << 20, 6


def overlaps_itself(motif: str) -> bool:
    return any(motif[q:] == motif[:-q] for q in range(1, len(motif)))


class Automaton:
    """States are numbers of the next letters; begins[state] has a bit for each motif whose first letters (WALK at most) they are."""

    def __init__(self, motifs: Sequence[str]) -> None:
        if not all(motifs) or len(motifs) > 62 or len(set(motifs)) < len(motifs):
            raise ValueError("1 to 62 different motifs of a letter or more")
        self.motifs, letters = list(motifs), sorted(set("".join(motifs).encode()))
        self.depth = min(WALK, max(map(len, motifs)))
        self.base = len(letters) + 1  # 0: any other letter
        self.code = np.zeros(256, np.uint8)
        self.code[letters] = np.arange(1, len(letters) + 1)
        self.begins = np.zeros(self.base**self.depth, np.int64)
        for i, m in enumerate(motifs):
            head = [int(self.code[c]) for c in m.encode()[: self.depth]]
            low = sum(c * self.base ** (self.depth - 1 - k) for k, c in enumerate(head))
            self.begins[low : low + self.base ** (self.depth - len(head))] |= 1 << i

    def walk(self, text: np.ndarray) -> np.ndarray:
        """For each place, the motifs whose first letters begin there, as bits; text ends with depth letters that aren't of any motif."""
        codes = self.code[text].astype(np.int32 if self.base**self.depth < 2**31 else np.int64)
        state = codes[: len(text) - self.depth].copy()
        for k in range(1, self.depth):
            state *= self.base
            state += codes[k : len(text) - self.depth + k]
        return self.begins[state]

    def starts(self, text: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(motif, its places) in several texts, one after the other in `text`, each before its end; none reaches past one."""
        found = self.walk(np.concatenate([text, np.zeros(self.depth, np.uint8)]))
        where = np.flatnonzero(found)
        bits, last = found[where], ends[np.searchsorted(ends, where, side="right")] if len(where) else where
        for i, m in enumerate(self.motifs):
            at = where[(bits >> i & 1).astype(bool) & (where + len(m) <= last)]
            for k in range(self.depth, len(m)):
                at = at[text[at + k] == ord(m[k])]
            yield i, at


def counted(at: np.ndarray, length: int, least: int = 0) -> np.ndarray:
    """Of an ordered run of places, those that count from the left, the first not before `least`; each next begins behind the last."""
    out, free = [], least
    for i, p in enumerate(at.tolist()):
        if p >= free:
            out.append(i)
            free = p + length
    return at[out]


def without_overlap(at: np.ndarray, text: np.ndarray, length: int) -> np.ndarray:
    """Places that count, of several texts: of a run of overlapping occurrences the first does, and runs of three and more are settled each by itself."""
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) >= length) | (np.diff(text) != 0)
    first, keep = np.flatnonzero(new), new.copy()
    size = np.diff(np.append(first, len(at)))
    for f, n in zip(first[size > 2], size[size > 2]):
        keep[f : f + n] = np.isin(at[f : f + n], counted(at[f : f + n], length), assume_unique=True)
    return at[keep]


def by_bytes(column: pa.Array, most: int = 1 << 22) -> Iterator[tuple[int, int]]:
    """First row and number of rows of parts of about `most` bytes."""
    ends, at = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)), 0
    while at < len(ends):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, to - at
        at = to


def tiles(contigs: DataFrame, key: str, seq: str, reach: int, tile: int) -> DataFrame:
    """contig, long (whether the contig has several), tile, bases: tiles with the `reach` letters behind them, so each occurrence lies whole in the tile that it begins in."""
    raw = contigs.select(F.col(key).alias("contig"), F.encode(F.col(seq), "UTF-8").alias("raw"))  # ASCII letters: cut by bytes
    at = F.sequence(F.lit(0).cast("long"), F.greatest(F.length("raw").cast("long") - 1, F.lit(0)), F.lit(tile).cast("long"))
    cut = F.transform(at, lambda a: F.struct((a / tile).cast("long").alias("tile"), F.substring(F.col("raw"), (a + 1).cast("int"), F.lit(tile + reach)).alias("bases")))
    return raw.where(F.length("raw") > 0).select("contig", (F.length("raw") > tile).alias("long"), F.explode(cut).alias("t")).select("contig", "long", "t.tile", "t.bases")


FOUND = "motif int, start0 long, run array<long>, ends array<int>"


def hits(contigs: DataFrame, motifs: Sequence[str], key: str = "chrom", seq: str = "seq", tile: int = TILE) -> DataFrame:
    """key, motif, start0 (0-based) of every occurrence that counts. Contigs are ASCII; null and empty ones have none. Keys are unique."""
    kind = contigs.select(key).schema[0].dataType.simpleString()
    reach, selfish = max(map(len, motifs)) - 1, {i for i, m in enumerate(motifs) if overlaps_itself(m)}
    cut = tiles(contigs, key, seq, reach, tile)
    dealt = cut.repartition("contig", "tile")
    names = pa.schema([("motif", pa.int32()), ("start0", pa.int64()), ("run", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32()))])

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Automaton(motifs)
        for whole in batches:
            for at, n in by_bytes(whole.column(3)):
                yield from scanned(auto, whole.slice(at, n))

    def scanned(auto: Automaton, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        text = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8)
        ends = np.cumsum(pc.binary_length(batch.column(3)).to_numpy(zero_copy_only=False).astype(np.int64))
        begins = np.concatenate([[0], ends[:-1]])
        long, number = batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
        for i, at in auto.starts(text, ends):
            k, of = len(motifs[i]), np.searchsorted(ends, at, side="right")
            inside = at - begins[of] < tile
            at, of = at[inside], of[inside]
            runs: list[list[int] | None] = []
            rows = np.zeros(0, np.int64)
            if i in selfish:
                # Of a long contig's tile the run at its begin stays open, and what it leaves to the next tile for each number of used letters.
                rows, cuts = np.flatnonzero(long), np.searchsorted(of, np.arange(len(batch) + 1))
                open_run = np.zeros(len(at), bool)
                functions = []
                for r in rows:
                    own = at[cuts[r] : cuts[r + 1]] - begins[r]
                    gaps = np.flatnonzero(np.diff(own) >= k)
                    n = 0 if not len(own) or own[0] >= k - 1 else int(gaps[0]) + 1 if len(gaps) else len(own)
                    open_run[cuts[r] : cuts[r] + n] = True
                    runs.append(own[:n].tolist())
                    rest = without_overlap(own[n:], np.zeros(len(own) - n, np.int64), k)
                    left = lambda some: max(0, int(some[-1]) + k - tile) if len(some) else 0
                    functions.append([left(rest) if n < len(own) else left(counted(own, k, used)) for used in range(k)])
                at, of = at[~open_run], of[~open_run]
                at = without_overlap(at, of, k)
                of = np.searchsorted(ends, at, side="right")
            start = at - begins[of] + number[of] * tile
            rows_of = pa.array(np.concatenate([of, rows]))
            columns = [batch.column(0).take(rows_of), batch.column(2).take(rows_of), pa.array(np.full(len(rows_of), i), pa.int32()), pa.array([*start.tolist(), *[None] * len(rows)] if len(rows) else start, pa.int64())]
            nothing = [None] * len(at)
            lists = [pa.array(nothing + runs, names.field("run").type), pa.array(nothing + functions, names.field("ends").type)] if len(rows) else [pa.nulls(len(at), names.field("run").type), pa.nulls(len(at), names.field("ends").type)]
            yield pa.RecordBatch.from_arrays([*columns, *lists], ["contig", "tile", *names.names])

    found = dealt.mapInArrow(f, f"contig {kind}, tile long, {FOUND}")
    name = F.element_at(F.array(*map(F.lit, motifs)), F.col("motif") + 1).alias("motif")
    if not selfish:
        return found.select(F.col("contig").alias(key), name, "start0")
    found = stored(found)
    settled = found.where("run is not null").repartition("contig", "motif").sortWithinPartitions("contig", "motif", "tile")

    def g(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, used = None, 0
        for batch in batches:
            rows, starts = [], []
            for r, (contig, t, motif, run, ends) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 4, 5)))):
                if (contig, motif) != last:
                    last, used = (contig, motif), 0
                got = counted(np.array(run, np.int64), len(motifs[motif]), used) + t * tile
                rows += [r] * len(got)
                starts += got.tolist()
                used = ends[used]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), batch.column(2).take(pa.array(rows, pa.int64())), pa.array(starts, pa.int64())], ["contig", "motif", "start0"])

    ran = settled.mapInArrow(g, f"contig {kind}, motif int, start0 long")
    every = found.where("start0 is not null").select("contig", "motif", "start0").unionByName(ran)
    return every.select(F.col("contig").alias(key), name, "start0")
