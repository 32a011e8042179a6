"""Hierarchical bins of places, as columns: an interval's bin is the smallest that holds it whole.

Level 0 is one bin, each next level cuts a bin in eight; the last level's bins are 2**SHIFT bases. A region's intervals lie in the bins of
its length and in the few larger ones above them, so a table that is sorted by bin is read at a handful of places.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bases of the smallest bins as a power of two, and levels below the first: 2**(14 + 3 * 6) bases in all.
SHIFT, LEVELS = 14, 6


def first_bin(level: int) -> int:
    return (8**level - 1) // 7


def shift_of(level: int, shift: int = SHIFT, levels: int = LEVELS) -> int:
    return shift + 3 * (levels - level)


def bin_of(start0: Column, stop0: Column, shift: int = SHIFT, levels: int = LEVELS) -> Column:
    """Bin of the closed span; 0 for what the smaller ones don't hold; null where an end is."""
    out = F.lit(0).cast("long")
    for level in range(1, levels + 1):
        s = shift_of(level, shift, levels)
        a, b = F.shiftright(start0.cast("long"), s), F.shiftright(stop0.cast("long"), s)
        out = F.when((a == b) & (a >= 0) & (a < 8**level), first_bin(level) + a).otherwise(out)
    return F.when(start0.isNotNull() & stop0.isNotNull(), out)


def bins_of_region(start0: int, stop0: int, shift: int = SHIFT, levels: int = LEVELS) -> list[tuple[int, int]]:
    """First and last bin of each level that hold intervals which may touch the closed region."""
    out = [(0, 0)]
    for level in range(1, levels + 1):
        s, last = shift_of(level, shift, levels), 8**level - 1
        a, b = max(0, start0) >> s, min(max(0, stop0) >> s, last)
        if a <= b:
            out.append((first_bin(level) + a, first_bin(level) + b))
    return out


def in_bins(column: Column, region: list[tuple[int, int]]) -> Column:
    """Whether a bin is one of a region's; as ranges, so that a scan can skip what lies between."""
    hit = F.lit(False)
    for a, b in region:
        hit = hit | ((column == a) if a == b else column.between(a, b))
    return hit
