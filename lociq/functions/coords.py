"""Locus keys and coordinate conversions as columns."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def locus(chrom: str | Column, start1: str | Column, stop1: str | Column, strand: str | Column) -> Column:
    """chrom:start-stop:strand, 1-based closed. Join on the columns; this is for output."""
    c = [F.col(x) if isinstance(x, str) else x for x in (chrom, start1, stop1, strand)]
    return F.format_string("%s:%d-%d:%s", *c)


def parsed(key: str | Column) -> Column:
    """Struct chrom, start1, stop1, strand of a locus key; chrom may hold : and -. Null if it's none."""
    k = F.col(key) if isinstance(key, str) else key
    part = lambda i: F.regexp_extract(k, r"^(.*):([0-9]+)-([0-9]+):([+-])$", i)
    good = k.rlike(r"^(.*):([0-9]+)-([0-9]+):([+-])$")
    fields = F.struct(part(1).alias("chrom"), F.try_to_number(part(2), F.lit("999999999999999999")).cast("long").alias("start1"), F.try_to_number(part(3), F.lit("999999999999999999")).cast("long").alias("stop1"), part(4).alias("strand"))
    return F.when(good, fields)


def natural(name: str | Column) -> Column:
    """Sort key that orders the numbers in names as numbers: chr2 before chr10."""
    n = F.col(name) if isinstance(name, str) else name
    parts = F.regexp_extract_all(n, F.lit("[0-9]+|[^0-9]+"), F.lit(0))
    # A number's length without leading zeros comes before its digits; other text sorts after numbers.
    digits = lambda x: F.regexp_replace(x, "^0+(?=.)", "")
    return F.struct(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), F.struct(F.length(digits(x)).alias("n"), digits(x).alias("x"))).otherwise(F.struct(F.lit(1 << 30).alias("n"), x.alias("x")))).alias("parts"), n.alias("name"))


def library(method: str, condition: str, replicate: str) -> Column:
    return F.concat_ws("-", method, condition, replicate)


def codons(start1: str, stop1: str) -> Column:
    return F.floor((F.col(stop1) - F.col(start1) + 1) / 3)


def with_stop_codon(strand: str, start1: str, stop1: str, by: int) -> tuple[Column, Column]:
    """start1, stop1 of an open reading frame drawn out by its stop codon in its direction."""
    fwd = F.col(strand) == "+"
    return F.when(fwd, F.col(start1)).otherwise(F.col(start1) - by), F.when(fwd, F.col(stop1) + by).otherwise(F.col(stop1))


def lengths(spec: str) -> list[int]:
    """Read lengths of a list such as "22,23,34-30": ranges in either order, each length once, sorted."""
    out: set[int] = set()
    for part in spec.replace(" ", "").split(","):
        ends = [int(x) for x in part.split("-")]
        if not 1 <= len(ends) <= 2:
            raise ValueError(f"not a length or a range: {part}")
        out |= set(range(min(ends), max(ends) + 1))
    return sorted(out)
