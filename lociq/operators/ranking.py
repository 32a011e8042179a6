"""Global ranks and running values by any order, without a task that holds a group or a run of ties.

Rows are range-sorted by all keys (a last one splits rows that are alike), so each range (band) is of bounded size however skewed or tied the values are.
Rows are numbered within bands; a table with a row a band and group carries counts, sums and minimums from band to band.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..tables import stored

#: Rows of a band have numbers below this (monotonically_increasing_id).
BAND = 1 << 33


def arranged(df: DataFrame, group: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """A table of df with __band and __at, in order of group and order."""
    x = df.withColumn("__salt", F.monotonically_increasing_id())
    keys = [*group, *order, "__salt"]
    x = x.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__salt").withColumn("__at", F.monotonically_increasing_id())
    return stored(x.withColumn("__band", F.floor(F.col("__at") / BAND)))


def _same(left: Sequence[str], right: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{right}{c}")) for c in left]


def _joined(x: DataFrame, bands: DataFrame, group: Sequence[str]) -> DataFrame:
    """Arranged rows with the columns of their band and group."""
    bands = bands.select(F.col("__band").alias("__b"), *[F.col(c).alias(f"__g{c}") for c in group], *[c for c in bands.columns if c != "__band" and c not in group])
    return x.join(bands, [F.col("__band") == F.col("__b"), *_same(group, "__g")]).drop("__b", *[f"__g{c}" for c in group])


def _of(group: Sequence[str]) -> Window:
    return Window.partitionBy(*(group or [F.lit(0)]))


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[Column], rank: str = "rank", counted: dict[str, Column] | None = None) -> DataFrame:
    """df with rank (1 and on within the group, a total order) and, for each counted condition, how many rows up to here fulfil it."""
    counted = counted or {}
    x = arranged(df, group, order)
    flag = {c: F.coalesce(v.cast("long"), F.lit(0)) for c, v in counted.items()}
    before = _of(group).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    sums = x.groupBy("__band", *group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"), *[F.sum(v).alias(f"__sum{c}") for c, v in flag.items()])
    earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    sums = sums.select("__band", *group, (F.col("__first") - earlier("__n")).alias("__shift"), *[earlier(f"__sum{c}").alias(f"__before{c}") for c in flag])
    out = _joined(x, sums, group).withColumn(rank, F.col("__at") - F.col("__shift") + 1)
    within = Window.partitionBy("__band", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    for c, v in flag.items():
        out = out.withColumn(c, F.sum(v).over(within) + F.col(f"__before{c}"))
    return out.drop("__band", "__at", "__shift", *[f"__before{c}" for c in flag])


def mean_ranked(df: DataFrame, group: Sequence[str], value: str, rank: str = "rank") -> DataFrame:
    """df with the mean rank of its value within the group: equal values share it. Ties are counted by value, not gathered."""
    values = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("__ties"))
    x = arranged(values, group, [F.col(value)])
    before = _of(group).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)
    sums = x.groupBy("__band", *group).agg(F.sum("__ties").alias("__n"))
    sums = sums.select("__band", *group, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("__band", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    upto = F.sum("__ties").over(within) + F.col("__before")
    values = _joined(x, sums, group).select(*[F.col(c).alias(f"__v{c}") for c in (*group, value)], (upto - (F.col("__ties") - 1) / 2).alias(rank))
    return df.join(values, _same([*group, value], "__v")).drop(*[f"__v{c}" for c in (*group, value)])


def step_up(df: DataFrame, p: str, group: Sequence[str] = (), out: str = "padj") -> DataFrame:
    """df with p-values adjusted for the false-discovery rate (Benjamini and Hochberg): the least of p * m / rank of this and all larger p-values, 1 at most.

    m are the group's p-values that aren't null or NaN; the others have none.
    """
    group, every = list(group), stored(df)  # read four times
    good = F.col(p).isNotNull() & ~F.isnan(F.col(p).cast("double"))
    x = ranked(every.where(good), group, [F.col(p)], "__rank")
    sizes = every.where(good).groupBy(*group).agg(F.count(F.lit(1)).alias("__m"))
    x = x.withColumn("__all", F.lit(0))
    sizes = sizes.select(*[F.col(c).alias(f"__s{c}") for c in group], "__m", F.lit(0).alias("__one"))
    x = x.join(sizes, [F.col("__all") == F.col("__one"), *_same(group, "__s")]).drop("__all", "__one", *[f"__s{c}" for c in group])
    # By falling rank: a frame that ends at the row is carried along, one that begins there is gone through again for each row.
    x = arranged(x.withColumn("__v", F.col(p) * F.col("__m") / F.col("__rank")), group, [F.desc("__rank")])
    least = x.groupBy("__band", *group).agg(F.min("__v").alias("__low"))
    least = least.select("__band", *group, F.min("__low").over(_of(group).orderBy("__band").rowsBetween(Window.unboundedPreceding, -1)).alias("__later"))
    within = Window.partitionBy("__band", *group).orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)
    x = _joined(x, least, group).withColumn(out, F.least(F.min("__v").over(within), F.coalesce("__later", F.lit(1.0)), F.lit(1.0)))
    return x.select(*df.columns, out).unionByName(every.where(~good | F.col(p).isNull()).withColumn(out, F.lit(None).cast("double")))
