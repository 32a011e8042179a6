"""Joins on overlapping intervals.

Both sides are entered under the bins that they touch, so the join is an equi-join on (keys, bin): it shuffles on
keys that are many and even, or broadcasts a small side by its size. A pair meets in several bins; it's kept in the first
that both touch. Long intervals would be entered many times, so the right side is split by length and each class has its own bin size.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bin sizes; an interval of the right side goes to the first that is at least a quarter of its length, or the last.
BINS = (1 << 10, 1 << 15, 1 << 20)


def _width_class(width: Column, bins: Sequence[int]) -> Column:
    """Place in bins of the size for an interval of the right side."""
    out = F.lit(len(bins) - 1)
    for i in reversed(range(len(bins) - 1)):
        out = F.when(width <= 4 * bins[i], i).otherwise(out)
    return out


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_span: tuple[str, str], right_span: tuple[str, str], how: str = "inner", margin: int = 0, bins: Sequence[int] = BINS) -> DataFrame:
    """Pairs with equal keys whose closed spans overlap, the right one widened by margin on both sides.

    The sides' columns other than the keys must have different names. how is inner, left_semi or left_anti. Rows with a null key
    or end overlap nothing.
    """
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(how)
    (a, b), (c, d) = left_span, right_span
    if how != "inner":
        # Equal spans share their fate: each is joined once, and only its ends come back.
        spans = left.select(*keys, a, b).distinct()
        other = right.select(*keys, F.col(c).alias("__c"), F.col(d).alias("__d"))
        hit = overlap_join(spans, other, keys, left_span, ("__c", "__d"), margin=margin, bins=bins).select(*keys, a, b).distinct()
        return left.join(hit, [*keys, a, b], how).select(*left.columns)
    low, high = F.col(c) - margin, F.col(d) + margin
    # A row of the left side is entered in the bins of each size that it touches, in one pass; one of the right side in those of its own size.
    of_size = lambda i, size: F.transform(F.sequence(F.floor(F.col(a) / size), F.floor(F.col(b) / size)), lambda x: F.struct(F.lit(i).alias("size"), x.alias("bin"), F.floor(F.col(a) / size).alias("first")))
    x = left.where(F.col(b) >= F.col(a)).withColumn("__e", F.explode(F.concat(*[of_size(i, size) for i, size in enumerate(bins)])))
    x = x.select(*left.columns, F.col("__e.size").alias("__size"), F.col("__e.bin").alias("__bin"), F.col("__e.first").alias("__left"))
    y = right.where(high >= low).withColumn("__size", _width_class(high - low + 1, bins))
    size = F.element_at(F.array(*[F.lit(s) for s in bins]), F.col("__size") + 1)
    y = y.withColumn("__right", F.floor(low / size)).withColumn("__bin", F.explode(F.sequence(F.col("__right"), F.floor(high / size))))
    both = x.join(y, [*keys, "__size", "__bin"])
    both = both.where((F.col("__bin") == F.greatest("__left", "__right")) & (F.col(a) <= high) & (F.col(b) >= low))
    return both.drop("__size", "__bin", "__left", "__right")


def overlaps_only_itself(df: DataFrame, keys: Sequence[str], span: tuple[str, str], id_col: str, distance: int) -> DataFrame:
    """The rows that no other row of df comes within distance of."""
    a, b = span
    other = df.select(*keys, F.col(a).alias("__a"), F.col(b).alias("__b"), F.col(id_col).alias("__id"))
    near = overlap_join(df, other, keys, span, ("__a", "__b"), margin=distance)
    crowded = near.where(F.col(id_col) != F.col("__id")).select(id_col).distinct()
    return df.join(crowded, id_col, "left_anti")


def labels_of_overlaps(df: DataFrame, genes: DataFrame, keys: Sequence[str], span: tuple[str, str], id_col: str, gene_span: tuple[str, str], label: str) -> DataFrame:
    """id_col, labels: the overlapping genes' labels by their start, comma-joined; rows without any have null."""
    pairs = overlap_join(df, genes.where(F.col(label).isNotNull()), keys, span, gene_span)
    found = pairs.groupBy(id_col).agg(F.array_sort(F.collect_set(F.struct(F.col(gene_span[0]).alias("s"), F.col(label).alias("l")))).alias("x"))
    return df.select(id_col).join(found.select(id_col, F.array_join(F.col("x.l"), ",").alias("labels")), id_col, "left")


def running(steps: DataFrame, keys: Sequence[str], sums: Sequence[str], tile: int = 1 << 16) -> DataFrame:
    """steps(keys, p, sums), a row a position, with the sums added up along p, and the next position as next.

    Rows are added up within tiles of positions; each tile starts from the totals of those before it, so no task sorts a chromosome.
    """
    steps = steps.withColumn("__tile", F.floor(F.col("p") / tile))
    tiles = steps.groupBy(*keys, "__tile").agg(F.min("p").alias("__first"), *[F.sum(c).alias(f"__{c}") for c in sums])  # a row a tile
    along = Window.partitionBy(*keys).orderBy("__tile")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    tiles = tiles.select(*keys, "__tile", F.lead("__first").over(along).alias("__next"), *[F.coalesce(F.sum(f"__{c}").over(before), F.lit(0)).alias(f"__{c}") for c in sums])
    inside = Window.partitionBy(*keys, "__tile").orderBy("p")
    x = steps.select(*keys, "__tile", "p", F.lead("p").over(inside).alias("__lead"), *[F.sum(c).over(inside).alias(c) for c in sums])
    x = x.join(tiles, [*keys, "__tile"])
    return x.select(*keys, "p", F.coalesce("__lead", "__next").alias("next"), *[(F.col(c) + F.col(f"__{c}")).alias(c) for c in sums])


def ends_of(df: DataFrame, keys: Sequence[str], span: tuple[str, str], weights: Sequence[str]) -> DataFrame:
    """keys, p, weights: by how much the summed weights change at each position where an interval begins, or after it ends."""
    a, b = span
    end = lambda p, sign: F.struct(p.alias("p"), *[(sign * F.col(w)).alias(w) for w in weights])
    ends = df.select(*keys, F.explode(F.array(end(F.col(a), 1), end(F.col(b) + 1, -1))).alias("e"))
    return ends.groupBy(*keys, F.col("e.p").alias("p")).agg(*[F.sum(f"e.{w}").alias(w) for w in weights])


def runs_of_depth(df: DataFrame, keys: Sequence[str], span: tuple[str, str], weight: str) -> DataFrame:
    """keys, start0, stop0, depth: stretches of equal nonzero summed weight (coverage as run lengths).

    Only interval ends are sorted, summed by position first; positions inside aren't expanded.
    """
    depth = running(ends_of(df, keys, span, [weight]).where(F.col(weight) != 0), keys, [weight])
    return depth.where(F.col(weight) != 0).select(*keys, F.col("p").alias("start0"), (F.col("next") - 1).alias("stop0"), F.col(weight).alias("depth"))
