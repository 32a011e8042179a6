"""Reads before alignment: quality cuts, adapters, merged pairs, and tables of read quality.

Reads are rows with id, seq and quality (Phred, from `!`). Rows keep their other columns. Tasks work on Arrow batches, all letters of a batch at once.
Null sequences count as empty. Letters other than A, C, G, T match nothing.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Fixed value: the character of quality 0.
PHRED = 33
#: Reads of a batch that are worked on at once.
ROWS = 4096


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of a text column, and where each text begins and ends in them."""
    raw = pc.fill_null(column.cast(pa.binary()), b"")
    ends = np.concatenate([[0], np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64))])
    return np.frombuffer(b"".join(raw.to_pylist()), np.uint8), ends


def _texts(letters: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """Stretches of letters as texts."""
    size = np.maximum(end - begin, 0)
    ends = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], size)
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(letters[at].tobytes()))


def _matrix(letters: np.ndarray, ends: np.ndarray, pad: int) -> np.ndarray:
    """Texts as rows of a matrix, filled up behind."""
    size = np.diff(ends)
    out = np.full((len(size), max(1, int(size.max(initial=0)))), pad, np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = letters
    return out


def _cut(reads: DataFrame, f: Callable[[np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """reads, of each only the stretch that f(letters, qualities, ends) gives as begins and ends among the letters."""
    seq, quality, schema = reads.columns.index("seq"), reads.columns.index("quality"), reads.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                letters, ends = _letters(batch.column(seq))
                q, q_ends = _letters(batch.column(quality))
                if not np.array_equal(ends, q_ends):
                    raise ValueError("a read has more bases than qualities, or fewer")
                begin, end = f(letters, q.astype(np.int64) - PHRED, ends)
                columns = [_texts(letters, begin, end) if i == seq else _texts(q, begin, end) if i == quality else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return reads.mapInArrow(run, schema)


def _tail(q: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Where each read's bad tail begins: of the sums of (least - quality) from the end on, up to the first that is negative, the place of the largest over 0."""
    begin, end = ends[:-1], ends[1:]
    some = end > begin
    out = end.copy()
    if not some.any():
        return out
    value = least - q
    before = np.concatenate([[0], np.cumsum(value)])
    read = np.repeat(np.arange(len(begin)), end - begin)
    sums = before[end][read] - before[:-1]
    at = np.arange(len(q))
    starts = begin[some]
    bad = np.full(len(begin), -1)
    bad[some] = np.maximum.reduceat(np.where(sums < 0, at, -1), starts)
    held = np.where(at > bad[read], sums, 0)
    best = np.zeros(len(begin), np.int64)
    best[some] = np.maximum.reduceat(held, starts)
    place = np.full(len(begin), -1)
    place[some] = np.maximum.reduceat(np.where((held == best[read]) & (held > 0), at, -1), starts)
    return np.where(place >= 0, place, out)


def quality_trimmed(reads: DataFrame, tail: int = 20, front: int = 0) -> DataFrame:
    """reads without bad ends: running sums of (limit - quality) from each end, cut where they are largest. Nothing is left where the cuts meet."""

    def f(letters: np.ndarray, q: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        stop = _tail(q, ends, tail)
        # From the front: the same on the mirrored reads.
        start = ends[:-1] if front <= 0 else len(q) - _tail(q[::-1], len(q) - ends[::-1], front)[::-1]
        met = start >= stop
        return np.where(met, ends[:-1], start), np.where(met, ends[:-1], stop)

    return _cut(reads, f)


def n_trimmed(reads: DataFrame) -> DataFrame:
    """reads without N at either end."""
    size = F.length("seq")
    front = size - F.length(F.ltrim("seq", F.lit("Nn")))
    kept = F.length(F.trim("seq", F.lit("Nn")))
    cut = lambda c: F.substring(F.col(c), (front + 1).cast("int"), kept.cast("int")).alias(c)
    return reads.select(*[cut(c) if c in ("seq", "quality") else F.col(c) for c in reads.columns])


def long_enough(reads: DataFrame, least: int = 10) -> DataFrame:
    return reads.where(F.length("seq") >= least)


@dataclass(frozen=True)
class Adapter:
    """seq of at most 64 letters; end 3: it and all behind it goes, and it may run past the read's end; end 5: it and all before it, and it may begin before the read."""

    seq: str
    end: int = 3

    def __post_init__(self) -> None:
        if self.end not in (3, 5) or not 1 <= len(self.seq) <= 64:
            raise ValueError("adapters have 1 to 64 letters and belong to end 3 or 5")


def adapters(listed: str, end: int = 3) -> list[Adapter]:
    """Of a comma-separated list."""
    return [Adapter(x.strip().upper(), end) for x in listed.split(",") if x.strip()]


def _may_match(m: np.ndarray, sizes: np.ndarray, adapter: np.ndarray, errors: np.ndarray, least: int) -> np.ndarray:
    """Rows of m in which the adapter, or at the end one of its beginnings, is found with few enough edits: Myers' bit vectors, a word a read."""
    k = len(adapter)
    one, top = np.uint64(1), np.uint64(k - 1)
    ones = np.uint64(2**k - 1)
    peq = np.zeros(256, np.uint64)
    for i, c in enumerate(adapter):
        peq[c] |= one << np.uint64(i)
    pv, mv = np.full(len(m), ones), np.zeros(len(m), np.uint64)
    score, found = np.full(len(m), k), np.zeros(len(m), bool)
    for j in range(m.shape[1]):
        eq = peq[m[:, j]]
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv), pv & xh
        score = score + (ph >> top & one).astype(np.int64) - (mh >> top & one).astype(np.int64)
        ph, mh = ph << one, mh << one  # row 0 costs nothing at any column
        new_pv, new_mv = (mh | ~(xv | ph)) & ones, ph & xv & ones
        inside = j < sizes
        pv, mv = np.where(inside, new_pv, pv), np.where(inside, new_mv, mv)
        found |= inside & (score <= errors[k])
    cost = np.zeros(len(m), np.int64)  # of the adapter's first letters, at the read's end
    for i in range(k):
        cost += (pv >> np.uint64(i) & one).astype(np.int64) - (mv >> np.uint64(i) & one).astype(np.int64)
        if i + 1 >= least:
            found |= cost <= errors[i + 1]
    return found


def _best(m: np.ndarray, sizes: np.ndarray, adapter: np.ndarray, errors: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches, edits and begin of each row's best place: most matches, then fewest edits, then leftmost. Matches are 0 where there's none."""
    # One number an alignment: edits, then matches (more is less), then its begin. Columns are the read's letters, cells the adapter's.
    edit, match = 1 << 40, 1 << 20
    k, rows = len(adapter), len(m)
    cells = [np.full(rows, i * edit, np.int64) for i in range(k + 1)]
    best = np.full(rows, -1, np.int64)
    out = np.zeros((3, rows), np.int64)

    def offer(value: np.ndarray, where: np.ndarray, length: int) -> None:
        edits = (value + edit // 2) >> 40
        rest = value - edits * edit
        matches = -(rest // match)
        begin = rest + matches * match
        rank = matches * edit - edits * match - begin + edit // 2
        better = where & (edits <= errors[length]) & (rank > best) & (matches > 0)
        best[better] = rank[better]
        out[:, better] = matches[better], edits[better], begin[better]

    for j in range(m.shape[1] + 1):
        at_end = sizes == j
        if at_end.any():
            for i in range(least, k):
                offer(cells[i], at_end, i)
        offer(cells[k], sizes >= j, k)
        if j == m.shape[1]:
            break
        diagonal = cells[0]
        cells[0] = np.full(rows, j + 1, np.int64)
        for i in range(1, k + 1):
            same = m[:, j] == adapter[i - 1]
            now = np.minimum(diagonal + np.where(same, -match, edit), np.minimum(cells[i], cells[i - 1]) + edit)
            diagonal, cells[i] = cells[i], now
    return out[0], out[1], out[2]


def adapter_trimmed(reads: DataFrame, found: Sequence[Adapter], rate: float = 0.1, least: int = 3) -> DataFrame:
    """reads without the best adapter of each: of the places with at most floor(rate * letters) edits, the one with most matches, then fewest edits, then the leftmost, then
    the first adapter's. Where it runs past the end, at least `least` of its letters must be there.

    Bit vectors find the reads that have any; only these are aligned.
    """
    held = [(np.frombuffer((a.seq if a.end == 3 else a.seq[::-1]).encode(), np.uint8), a.end) for a in found]

    def f(letters: np.ndarray, q: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.diff(ends)
        begin, end = ends[:-1].copy(), ends[1:].copy()
        m = np.where(np.isin(letters, np.frombuffer(b"ACGT", np.uint8)), letters, 0).astype(np.uint8)
        ways = {3: _matrix(m, ends, 0), 5: _matrix(m[::-1], len(m) - ends[::-1], 0)[::-1]}
        best = np.full((3, len(sizes)), [[0], [0], [0]])
        for a, side in held:
            errors = np.floor(rate * np.arange(len(a) + 1) + 1e-9).astype(np.int64)
            some = np.flatnonzero(_may_match(ways[side], sizes, a, errors, min(least, len(a))))
            if not len(some):
                continue
            now = np.array(_best(ways[side][some], sizes[some], a, errors, min(least, len(a))))
            old = best[:, some]
            better = (now[0] > old[0]) | (now[0] == old[0]) & (now[0] > 0) & ((now[1] < old[1]) | (now[1] == old[1]) & (now[2] < old[2]))
            rows = some[better]
            best[:, rows] = now[:, better]
            begin[rows], end[rows] = ends[:-1][rows], ends[1:][rows]
            if side == 3:
                end[rows] = ends[:-1][rows] + now[2][better]
            else:
                begin[rows] = ends[1:][rows] - now[2][better]
        return begin, end

    return _cut(reads, f)


def prepared(reads: DataFrame, found: Sequence[Adapter] = (), tail: int = 20, least: int = 10) -> DataFrame:
    """Quality cut, adapters, N at the ends, and reads that are long enough, in this order."""
    x = quality_trimmed(reads, tail)
    x = adapter_trimmed(x, found) if found else x
    return long_enough(n_trimmed(x), least)


#: Highest quality of a base that both reads of a pair have, and lowest of one they differ in.
MOST, LEAST = 41, 2


def _merged(a: np.ndarray, qa: np.ndarray, na: np.ndarray, b: np.ndarray, qb: np.ndarray, nb: np.ndarray, overlap: int, rate: float) -> tuple[np.ndarray, ...]:
    """Offset of the mate (turned around) in the read, its score and whether it fits, for each pair."""
    rows, best = len(a), np.full(len(a), -(1 << 30))
    offset, wrong = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    wide = np.zeros(rows, np.int64)
    short = max(a.shape[1], b.shape[1]) <= 64
    if short:
        (*at, known), (*bt, b_known) = _bits(a), _bits(b)
    for d in range(-(b.shape[1] - 1), a.shape[1]):
        lo, hi = np.maximum(0, d), min(a.shape[1], d + b.shape[1])
        size = np.minimum(na, d + nb) - lo
        if short:
            moved = (lambda v: v << np.uint64(d)) if d >= 0 else (lambda v: v >> np.uint64(-d))  # noqa: B023
            same = sum(np.bitwise_count(x & moved(y)).astype(np.int64) for x, y in zip(at, bt))
            differ = np.bitwise_count(known & moved(b_known)).astype(np.int64) - same
        else:
            x, y = a[:, lo:hi], b[:, lo - d : hi - d]
            same = ((x == y) & (x > 0)).sum(axis=1)
            differ = ((x != y) & (x > 0) & (y > 0)).sum(axis=1)
        score = same - differ
        better = (size >= overlap) & ((score > best) | (score == best) & (size > wide))
        best[better], offset[better], wrong[better], wide[better] = score[better], d, differ[better], size[better]
    return offset, best, (best > 0) & (wrong <= rate * wide)


def _bits(letters: np.ndarray) -> list[np.ndarray]:
    """A number a read for A, C, G, T and any of them: bit i tells of position i."""
    place = np.uint64(1) << np.arange(letters.shape[1], dtype=np.uint64)
    each = [((letters == x) * place).sum(axis=1, dtype=np.uint64) for x in b"ACGT"]
    return [*each, each[0] | each[1] | each[2] | each[3]]


def _strings(parts: list[np.ndarray]) -> pa.Array:
    """The rows of matrices of letters, one after another."""
    size = np.concatenate([np.zeros(1, np.int64), *[np.full(len(p), p.shape[1]) for p in parts]])
    data = np.concatenate([np.zeros(0, np.uint8), *[p.ravel() for p in parts]])
    return pa.StringArray.from_buffers(len(size) - 1, pa.py_buffer(np.cumsum(size).astype(np.int32)), pa.py_buffer(data))


def merged_pairs(reads: DataFrame, mates: DataFrame, overlap: int = 10, rate: float = 0.1, least: int = 10) -> DataFrame:
    """id, seq, quality, overlap of pairs (equal ids) that fit together: the mate is turned around and tried at every offset.

    The best offset has the highest score (equal less differing bases), then the longest overlap, then comes first. It must overlap by `overlap` bases, with
    at most `rate` of them differing. Where both have a base, qualities add up to MOST at most; where they differ the better one
    stays (the read's if equal) with the difference, LEAST at least. What a mate has before the read's begin, or a read behind the mate's end, is adapter and goes.
    Repeated ids pair with each other.
    """
    both = reads.select("id", F.coalesce("seq", F.lit("")).alias("a"), F.coalesce("quality", F.lit("")).alias("qa")).join(mates.select("id", F.coalesce("seq", F.lit("")).alias("b"), F.coalesce("quality", F.lit("")).alias("qb")), "id")
    kind = both.schema["id"].dataType.simpleString()
    turn = np.zeros(256, np.uint8)
    keep = np.zeros(256, np.uint8)
    for x, y in zip(b"ACGT", b"TGCA"):
        turn[x], keep[x] = y, x

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                (a, ea), (qa, _), (b, eb), (qb, _) = (_letters(batch.column(i)) for i in range(1, 5))
                na, nb = np.diff(ea), np.diff(eb)
                ma, mqa = _matrix(keep[a], ea, 0), _matrix(qa - PHRED, ea, 0).astype(np.int64)
                mb = _matrix(turn[b[::-1]], len(b) - eb[::-1], 0)[::-1]
                mqb = _matrix((qb - PHRED)[::-1], len(b) - eb[::-1], 0)[::-1].astype(np.int64)
                offset, _, good = _merged(ma, mqa, na, mb, mqb, nb, overlap, rate)
                rows, seqs, quals, shared = [np.zeros(0, np.int64)], [], [], [np.zeros(0, np.int64)]
                good = np.flatnonzero(good)
                alike, which = np.unique(np.column_stack([offset, na, nb])[good], axis=0, return_inverse=True)
                order = np.argsort(which.ravel(), kind="stable")
                # Pairs of one offset and equal lengths at once.
                for (d, n, k), r in zip(alike.tolist(), np.split(good[order], np.cumsum(np.bincount(which.ravel(), minlength=len(alike)))[:-1])):
                    lo, hi = max(0, d), min(n, d + k)
                    x, y, p, q = ma[r, lo:hi], mb[r, lo - d : hi - d], mqa[r, lo:hi], mqb[r, lo - d : hi - d]
                    first = (y == 0) | (x != 0) & (p >= q)
                    base = np.where(first, x, y)
                    level = np.where(x == y, np.minimum(p + q, MOST), np.where((x == 0) | (y == 0), np.where(first, p, q), np.maximum(abs(p - q), LEAST)))
                    through = d < 0 or d + k < n
                    head, tail = (0, 0) if through else (d, d + k - n)
                    s = np.concatenate([ma[r, :head], base, mb[r, k - tail : k]], axis=1)
                    rows.append(r)
                    seqs.append(np.where(s == 0, ord("N"), s).astype(np.uint8))
                    quals.append((np.concatenate([mqa[r, :head], level, mqb[r, k - tail : k]], axis=1) + PHRED).astype(np.uint8))
                    shared.append(np.full(len(r), hi - lo))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.concatenate(rows))), _strings(seqs), _strings(quals), pa.array(np.concatenate(shared))], ["id", "seq", "quality", "overlap"])

    return both.mapInArrow(f, f"id {kind}, seq string, quality string, overlap long").where(F.length("seq") >= least)


def by_position(reads: DataFrame) -> DataFrame:
    """position (from 0), quality, base, n: a row for what occurs. Each task adds up its own; tables of tasks are added up."""
    names = ["position", "quality", "base", "n"]

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray = np.zeros(0, np.int64)
        for batch in batches:
            letters, ends = _letters(batch.column(0))
            q, q_ends = _letters(batch.column(1))
            if not np.array_equal(ends, q_ends):
                raise ValueError("a read has more bases than qualities, or fewer")
            place = np.arange(len(letters)) - np.repeat(ends[:-1], np.diff(ends))
            now = np.bincount((place << 14) + ((q.astype(np.int64) - PHRED) << 7) + (letters & 127)) if len(letters) else np.zeros(0, np.int64)
            if len(now) > len(total):
                total, now = now, total
            total[: len(now)] += now
        at = np.flatnonzero(total)
        base = np.array([chr(c) for c in range(128)], object)[at & 127]
        yield pa.RecordBatch.from_arrays([pa.array(at >> 14), pa.array((at >> 7 & 127).astype(np.int32)), pa.array(base, pa.string()), pa.array(total[at])], names)

    return reads.select("seq", "quality").mapInArrow(f, "position long, quality int, base string, n long").groupBy("position", "quality", "base").agg(F.sum("n").alias("n"))


def quality_quantiles(positions: DataFrame, quantiles: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """position, n, mean, q10.. of by_position's table: the least quality that a share of the bases doesn't exceed."""
    levels = positions.groupBy("position", "quality").agg(F.sum("n").alias("n"))  # at most a row a quality
    w = Window.partitionBy("position")
    x = levels.withColumn("all", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy("quality")))
    found = [F.min(F.when(F.col("upto") >= p * F.col("all"), F.col("quality"))).alias(f"q{round(p * 100)}") for p in quantiles]
    return x.groupBy("position").agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("quality")) / F.sum("n")).alias("mean"), *found)


def content(reads: DataFrame) -> DataFrame:
    """gc (percent of A, C, G, T that is G or C, rounded; null without any), length, n."""
    count = lambda c: F.length("seq") - F.length(F.translate("seq", c, ""))
    gc, at = count("GCgc"), count("ATat")
    return reads.select(F.round(100 * gc / F.nullif(gc + at, F.lit(0))).cast("int").alias("gc"), F.length("seq").alias("length")).groupBy("gc", "length").agg(F.count(F.lit(1)).alias("n"))


def heavy_sequences(reads: DataFrame, share: float = 0.001) -> DataFrame:
    """seq, n of the sequences that more than `share` of all reads have, exactly.

    A sequence with such a share of all reads has it in one task at least, and there it is left in a summary of 1 / share counters (each new sequence
    without a counter takes one from all). Only what summaries hold is counted.
    """
    counters = int(1 / share) + 1

    def f(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for batch in batches:
            some = pc.value_counts(pc.fill_null(batch.column(0), ""))
            for name, n in zip(some.field("values").to_pylist(), some.field("counts").to_pylist()):
                held[name] = held.get(name, 0) + n
            if len(held) > counters:
                # What many new sequences take together: the counters' height at the last one that stays.
                cut = sorted(held.values(), reverse=True)[counters]
                held = {k: v - cut for k, v in held.items() if v > cut}
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string())], ["seq"])

    seqs = reads.select(F.coalesce("seq", F.lit("")).alias("seq"))
    summary = seqs.mapInArrow(f, "seq string").distinct()
    counted = seqs.join(summary, "seq", "left_semi").groupBy("seq").agg(F.count(F.lit(1)).alias("n"))
    every = seqs.agg(F.count(F.lit(1)).alias("every"))  # one row
    return counted.join(F.broadcast(every), F.col("n") > share * F.col("every")).select("seq", "n")


def duplication(reads: DataFrame) -> DataFrame:
    """level (how often a sequence comes), sequences, reads."""
    each = reads.groupBy(F.coalesce("seq", F.lit("")).alias("seq")).agg(F.count(F.lit(1)).alias("level"))
    return each.groupBy("level").agg(F.count(F.lit(1)).alias("sequences"), F.sum("level").alias("reads"))
