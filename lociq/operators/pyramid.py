"""Track pyramid: summaries of a track at doubling widths, made from its run lengths, and a reader that picks the level for a region.

A level's tile has count (positions with a value), least, greatest, total and squares of their values. Runs are cut at the borders of the finest tiles, so work grows with
tiles that hold something, not with positions. Coarser levels are sums of finer ones.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Positions of the finest tiles, and levels: the widest tiles are WIDTH * 2**(LEVELS - 1).
WIDTH, LEVELS = 64, 16
SUMS = ("count", "least", "greatest", "total", "squares")


def _added() -> list:
    return [F.sum("count").alias("count"), F.min("least").alias("least"), F.max("greatest").alias("greatest"), F.sum("total").alias("total"), F.sum("squares").alias("squares")]


def finest(runs: DataFrame, keys: Sequence[str], value: str = "depth", width: int = WIDTH) -> DataFrame:
    """keys, tile and the five sums of runs(keys, start0, stop0, value), closed spans that don't overlap."""
    x = runs.where((F.col("stop0") >= F.col("start0")) & F.col(value).isNotNull())
    x = x.select(*keys, "start0", "stop0", F.col(value).cast("double").alias("v"), F.explode(F.sequence(F.floor(F.col("start0") / width), F.floor(F.col("stop0") / width))).alias("tile"))
    n = F.least("stop0", (F.col("tile") + 1) * width - 1) - F.greatest("start0", F.col("tile") * width) + 1
    x = x.select(*keys, "tile", n.cast("long").alias("count"), F.col("v").alias("least"), F.col("v").alias("greatest"), (F.col("v") * n).alias("total"), (F.col("v") * F.col("v") * n).alias("squares"))
    return x.groupBy(*keys, "tile").agg(*_added())


def levels(runs: DataFrame, keys: Sequence[str], value: str = "depth", width: int = WIDTH, levels: int = LEVELS) -> DataFrame:
    """level (0 is the finest), keys, tile and the five sums, of all levels: each finest tile is entered under the tile of each level that holds it, and added up before the shuffle."""
    x = finest(runs, keys, value, width)
    up = F.explode(F.transform(F.sequence(F.lit(0), F.lit(levels - 1)), lambda k: F.struct(k.alias("level"), F.floor(F.col("tile") / F.pow(F.lit(2.0), k)).alias("at"))))
    x = x.withColumn("up", up).select(F.col("up.level").alias("level"), *keys, F.col("up.at").alias("tile"), *SUMS)
    return x.groupBy("level", *keys, "tile").agg(*_added())


def write(pyramid: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Folders by level, in files of ranges of keys and tiles."""
    order = ["level", *keys, "tile"]
    pyramid.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy("level").option("parquet.block.size", 1 << 22).parquet(path)


def level_of(start0: int, stop0: int, points: int, width: int = WIDTH, levels: int = LEVELS) -> int:
    """The finest level at which the closed region has at most `points` tiles; the coarsest if none has."""
    for k in range(levels):
        w = width << k
        if stop0 // w - start0 // w + 1 <= points:
            return k
    return levels - 1


def region(pyramid: DataFrame, of: dict[str, str], start0: int, stop0: int, points: int = 1000, width: int = WIDTH, levels: int = LEVELS) -> DataFrame:
    """start0, stop0, the five sums, mean and deviation of each tile that holds something of the region, at the level for so many points. Only that level's folder is read."""
    k = level_of(start0, stop0, points, width, levels)
    w = width << k
    x = pyramid.where((F.col("level") == k) & F.col("tile").between(start0 // w, stop0 // w))
    for c, v in of.items():
        x = x.where(F.col(c) == v)
    mean = F.col("total") / F.col("count")
    spread = F.sqrt(F.greatest(F.col("squares") / F.col("count") - mean * mean, F.lit(0.0)))
    return x.select((F.col("tile") * w).alias("start0"), ((F.col("tile") + 1) * w - 1).alias("stop0"), *SUMS, mean.alias("mean"), spread.alias("deviation"))
