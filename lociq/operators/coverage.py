"""Coverage tracks and occupancy by position.

Alignments have library, chrom, strand, start0 and end0 (exclusive), nh. Reverse-strand values are negative.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import ends_of

STYLES = ("global", "fiveprime", "threeprime", "centered")
KEYS = ["library", "chrom", "strand"]
#: Positions of a tile that reads are added up in, and reads a task, about.
TILE, READS_A_TASK = 10_000, 1 << 17


def _fwd() -> Column:
    return F.col("strand") == "+"


def tasks_for(reads: DataFrame) -> int:
    """How many tasks to deal the rows of reads into, so that what a task holds doesn't grow with them."""
    return max(reads.sparkSession.sparkContext.defaultParallelism, -(-reads.count() // READS_A_TASK))


def _summed(reads: DataFrame, split_multi: bool, count: str, tasks: int | None) -> DataFrame:
    """Equal reads as one row with their summed increments; of those dealt into tasks, one a part of the input that they were read from, so that no place's reads meet in one task."""
    inc = F.col(count) / F.col("nh") if split_multi else F.col(count).cast("double")
    x = reads.where("end0 > start0").select(*KEYS, "start0", "end0", F.when(_fwd(), inc).otherwise(-inc).alias("inc"), (F.spark_partition_id() if tasks else F.lit(0)).alias("__of"))
    x = x.repartition(tasks, *KEYS, "start0", "end0", "__of") if tasks else x
    return x.groupBy(*KEYS, "start0", "end0", "__of").agg(F.sum("inc").alias("inc")).drop("__of")


def runs(reads: DataFrame, style: str, clip: int = 11, split_multi: bool = True, count: str = "n", tasks: int | None = None) -> DataFrame:
    """library, chrom, strand, tile, start0, stop0, value: stretches of one value in the styles that cover stretches, cut at every TILE positions.

    Reads go to the tiles that they touch, where changes at their ends are added up, so one shuffle by tile is all that follows the sum of equal reads. A whole number,
    the reads that cover a position, says where a stretch of rounded sums ends.
    """
    if style not in ("global", "centered"):
        raise ValueError(style)
    cut = 0 if style == "global" else clip
    base = _summed(reads, split_multi, count, tasks).withColumn("a", F.col("start0") + cut).withColumn("b", F.col("end0") - 1 - cut).where("b >= a")
    value = F.col("inc") if style == "global" else F.col("inc") / (F.col("b") - F.col("a") + 1)
    x = base.select(*KEYS, "a", "b", value.alias("value"), F.explode(F.sequence(F.floor(F.col("a") / TILE), F.floor(F.col("b") / TILE))).alias("tile"))
    keys = [*KEYS, "tile"]
    x = x.repartition(tasks, *keys) if tasks else x
    inside = x.select(*keys, F.greatest("a", F.col("tile") * TILE).alias("a"), F.least("b", (F.col("tile") + 1) * TILE - 1).alias("b"), "value", F.lit(1).cast("long").alias("reads"))
    along = Window.partitionBy(*keys).orderBy("p")
    steps = ends_of(inside, keys, ("a", "b"), ["value", "reads"])
    sums = steps.select(*keys, "p", F.lead("p").over(along).alias("next"), F.sum("value").over(along).alias("value"), F.sum("reads").over(along).alias("reads"))
    return sums.where("reads > 0").select(*keys, F.col("p").alias("start0"), (F.col("next") - 1).alias("stop0"), "value").where("value <> 0")


def binned(stretches: DataFrame, width: int) -> DataFrame:
    """library, chrom, strand, bin, positions, total, peak of runs' result, by bins of width positions, which TILE must be a multiple of: positions aren't expanded, nor shuffled again."""
    if TILE % width:
        raise ValueError(width)
    a, b, k = F.col("start0"), F.col("stop0"), F.col("bin")
    x = stretches.withColumn("bin", F.explode(F.sequence(F.floor(a / width), F.floor(b / width)))).withColumn("n", F.least(b, (k + 1) * width - 1) - F.greatest(a, k * width) + 1)
    x = x.groupBy(*KEYS, "tile", "bin").agg(F.sum("n").alias("positions"), F.sum(F.col("value") * F.col("n")).alias("total"), F.max(F.abs("value")).alias("peak"))
    return x.drop("tile")


def track(reads: DataFrame, style: str, clip: int = 11, split_multi: bool = True, count: str = "n", tasks: int | None = None) -> DataFrame:
    """library, chrom, strand, pos, value: summed increments of 1 / nh at the positions that the style covers.

    Equal reads are summed first. Where they cover stretches, these are found as by runs(), and only the result is expanded to positions.
    """
    if style not in STYLES:
        raise ValueError(style)
    if style in ("global", "centered"):
        found = runs(reads, style, clip, split_multi, count, tasks)
        return found.select(*KEYS, F.explode(F.sequence("start0", "stop0")).alias("pos"), "value")
    first, last = F.col("start0"), F.col("end0") - 1
    at = F.when(_fwd(), first).otherwise(last) if style == "fiveprime" else F.when(_fwd(), last).otherwise(first)
    points = _summed(reads, split_multi, count, tasks).select(*KEYS, at.alias("pos"), F.col("inc").alias("value"))
    return points.groupBy(*KEYS, "pos").agg(F.sum("value").alias("value")).where("value <> 0")


def normalised(tracks: DataFrame, totals: DataFrame, how: str) -> DataFrame:
    """raw, mil (by million mapped reads of the library and chromosome) or min (to the smallest library); chromosomes without totals go."""
    if how == "raw":
        return tracks
    least = F.min("n").over(Window.partitionBy("chrom"))
    factor = {"mil": 1e6 / F.col("n"), "min": least / F.col("n")}[how]
    factors = totals.select("library", "chrom", factor.alias("factor"))
    return tracks.join(factors, ["library", "chrom"]).withColumn("value", F.col("value") * F.col("factor")).drop("factor")


def a_sites(reads: DataFrame, mirrored: bool = True, offset: int = 12) -> DataFrame:
    """library, chrom, strand, pos, cnt: ribosomal A-sites, offset bases before the 3' end.

    mirrored=False counts on the reverse strand back from the leftmost base by the read's length, as older tracks do.
    """
    fwd = F.col("start0") + F.col("read_length") - offset + 1
    rev = F.col("start0") + offset - 2 if mirrored else F.col("start0") + 1 - F.col("read_length") + offset - 1
    used = reads.where(F.col("flag").isin(0, 16))
    return used.withColumn("pos", F.when(_fwd(), fwd).otherwise(rev)).groupBy(*KEYS, "pos").agg(F.sum("n").alias("cnt"))


def wiggle(tracks: DataFrame) -> DataFrame:
    """library, strand, chrom, block: variableStep text, one block of at most a thousand lines a chromosome, 1-based."""
    part = F.floor(F.col("pos") / 1000)
    line = F.concat_ws(" ", (F.col("pos") + 1).cast("string"), F.col("value").cast("string"))
    rows = tracks.withColumn("part", part).groupBy("library", "strand", "chrom", "part").agg(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))).alias("x"))
    head = F.concat(F.lit("variableStep chrom="), F.col("chrom"), F.lit(" span=1\n"))
    return rows.select("library", "strand", "chrom", "part", F.concat(head, F.array_join(F.col("x.line"), "\n")).alias("block"))
