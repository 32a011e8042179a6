"""Attribute lists of annotation rows, as map columns."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of value, which is worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _first_wins(pairs: Column) -> Column:
    """Map of an array of (key, value) structs; of equal keys the first counts."""
    kept = lambda pairs, keys: F.filter(pairs, lambda p, i: F.array_position(keys, p["k"]) == i + 1)
    return _with(pairs, lambda x: _with(F.transform(x, lambda p: p["k"]), lambda keys: F.map_from_entries(kept(x, keys))))


def _fields(attributes: Column) -> Column:
    return F.filter(F.transform(F.split(attributes, "[;=]"), lambda x: F.trim(x)), lambda x: x != "")


def gff3(attributes: str | Column) -> Column:
    """Map of key=value; lists: keys lower-cased, blanks and empty entries dropped, the first of equal keys kept. Null where malformed."""
    a = F.col(attributes) if isinstance(attributes, str) else attributes
    pairs = lambda f: F.transform(F.filter(F.transform(f, lambda x, i: F.struct(F.lower(x).alias("k"), F.get(f, i + 1).alias("v"), i.alias("i"))), lambda p: p["i"] % 2 == 0), lambda p: F.struct(p["k"].alias("k"), p["v"].alias("v")))
    return _with(_fields(a), lambda f: F.when(F.size(f) % 2 == 0, _first_wins(pairs(f))))


def malformed(attributes: str | Column) -> Column:
    """Whether the list has a key without a value."""
    a = F.col(attributes) if isinstance(attributes, str) else attributes
    return F.size(_fields(a)) % 2 == 1


def gtf(attributes: str | Column) -> Column:
    """Map of key "value"; lists; empty values dropped, the first of equal keys kept."""
    a = F.col(attributes) if isinstance(attributes, str) else attributes
    pattern = r'([A-Za-z0-9_]+) "([^"]*)"'
    pairs = F.arrays_zip(F.transform(F.regexp_extract_all(a, F.lit(pattern), F.lit(1)), lambda x: F.lower(x)).alias("k"), F.regexp_extract_all(a, F.lit(pattern), F.lit(2)).alias("v"))
    return _first_wins(F.filter(pairs, lambda p: p["v"] != ""))


def first_of(attrs: str | Column, *names: str) -> Column:
    """The first of the named attributes that isn't empty."""
    m = F.col(attrs) if isinstance(attrs, str) else attrs
    return F.coalesce(*(F.nullif(F.try_element_at(m, F.lit(n)), F.lit("")) for n in names))


def written(attrs: str | Column) -> Column:
    """key=value; for each entry, by key."""
    m = F.col(attrs) if isinstance(attrs, str) else attrs
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(e["key"], F.lit("="), e["value"], F.lit(";"))), "")


def gff3_of_gtf(attrs: Column, kind: Column, gene: Column) -> Column:
    """A GFF3 attribute list from a GTF map: ID from kind and gene, parent for what isn't a gene, and the rest but gene_id."""
    rest = F.map_filter(attrs, lambda k, v: ~k.isin("gene_id", "transcript_id") & (v != ""))
    parent = F.when(kind != "gene", F.concat(F.lit("Parent=gene-"), gene, F.lit(";"))).otherwise(F.lit(""))
    return F.concat(F.lit("ID="), kind, F.lit("-"), gene, F.lit(";"), parent, written(rest))
