"""Read profiles around start and stop codons."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .counting import accepted
from .intervals import overlap_join


def _end(site: str) -> Column:
    """The codon's outer base: the gene's first base, or its last."""
    fwd = F.col("strand") == "+"
    return F.when(fwd, F.col("f_start0")).otherwise(F.col("f_stop0")) if site == "start" else F.when(fwd, F.col("f_stop0")).otherwise(F.col("f_start0"))


def profile(reads: DataFrame, genes: DataFrame, site: str, style: str, outside: int, inside: int, mirrored_stop: bool = False) -> DataFrame:
    """chrom, read_length, coord, cnt of accepted reads.

    coord is the distance downstream from the gene's first base (start) or its last base less 1 (stop: -1 is
    the last base). mirrored_stop counts the stop profile from its downstream end, as older tables do.
    """
    if site not in ("start", "stop"):
        raise ValueError(site)
    fwd = F.col("strand") == "+"
    anchor = _end(site)
    before, after = (outside, inside - 1) if site == "start" else (inside - 1, outside)  # in the direction of reading
    low = F.when(fwd, anchor - before).otherwise(anchor - after)
    windows = genes.select("chrom", "strand", "id", anchor.alias("anchor"), low.alias("w0"), (low + before + after).alias("w1"))
    pairs = overlap_join(reads.where(accepted()), windows, ["chrom", "strand"], ("start0", "stop0"), ("w0", "w1"))
    if style == "global":
        pairs = pairs.withColumn("p", F.explode(F.sequence(F.greatest("start0", "w0"), F.least("stop0", "w1"))))
    else:
        five = F.when(fwd, F.col("start0")).otherwise(F.col("stop0"))
        three = F.when(fwd, F.col("stop0")).otherwise(F.col("start0"))
        point = {"fiveprime": five, "threeprime": three, "centered": F.bround((F.col("start0") + F.col("stop0")) / 2).cast("long")}[style]
        pairs = pairs.withColumn("p", point).where("p between w0 and w1")
    away = F.when(fwd, F.col("p") - F.col("anchor")).otherwise(F.col("anchor") - F.col("p"))
    coord = away if site == "start" else away - 1
    if site == "stop" and mirrored_stop:
        coord = F.lit(outside - inside) - away  # index 0, named -inside, is the base furthest downstream
    return pairs.groupBy("chrom", "read_length", coord.alias("coord")).agg(F.sum("n").alias("cnt"))


def completed(p: DataFrame, low: int, high: int) -> DataFrame:
    """Every coordinate from low to high for each chromosome and read length that is seen."""
    grid = p.select("chrom", "read_length").distinct().withColumn("coord", F.explode(F.sequence(F.lit(low).cast("long"), F.lit(high).cast("long"))))
    return grid.join(p.withColumn("coord", F.col("coord").cast("long")), ["chrom", "read_length", "coord"], "left").withColumn("cnt", F.coalesce("cnt", F.lit(0)))


def cpm(p: DataFrame, totals: DataFrame) -> DataFrame:
    """Counts by million accepted reads of the chromosome, in totals(chrom, total)."""
    return p.join(totals, "chrom").withColumn("value", F.col("cnt") * 1e6 / F.col("total")).drop("total")


def window_normalised(p: DataFrame, width: int) -> DataFrame:
    """Counts divided by the mean over the window of the chromosome and read length; null where that is 0."""
    total = F.sum("cnt").over(Window.partitionBy("chrom", "read_length"))
    return p.withColumn("value", F.try_divide(F.col("cnt").cast("double"), total / width))


def wide(p: DataFrame, lengths: list[int], value: str = "cnt") -> DataFrame:
    """chrom, coord, one column a read length and their sum."""
    out = p.groupBy("chrom", "coord").pivot("read_length", lengths).agg(F.sum(value))
    out = out.select("chrom", "coord", *[F.coalesce(F.col(f"`{x}`"), F.lit(0)).alias(f"len_{x}") for x in lengths])
    return out.withColumn("sum", sum((F.col(f"len_{x}") for x in lengths), F.lit(0)))


def gene_reasons(genes: DataFrame, all_features: DataFrame, reads: DataFrame, positions_in: int, length_cutoff: int, distance: int, rpkm_threshold: float) -> DataFrame:
    """id, reason: why a feature isn't profiled, by the first test that it fails: type, overlap, length, rpkm; else included."""
    from .counting import count_by_style, rpkm
    from .intervals import overlaps_only_itself

    cds = genes.where(F.lower("feature") == "cds")
    alone = overlaps_only_itself(cds, ["chrom", "strand"], ("f_start0", "f_stop0"), "id", distance).select("id", F.lit(True).alias("alone"))
    counts = count_by_style(reads, cds, "global")
    total = reads.where(accepted()).groupBy("chrom").agg(F.sum("n").alias("total"))
    x = all_features.join(alone, "id", "left").join(counts, "id", "left").join(total, "chrom", "left")
    length = F.col("f_stop0") - F.col("f_start0") + 1
    value = rpkm(F.coalesce("cnt", F.lit(0)), F.coalesce("total", F.lit(0)), length)
    reason = F.when(F.lower("feature") != "cds", "type").when(F.col("alone").isNull(), "overlap").when((length < positions_in) | (length < length_cutoff), "length").when(value < rpkm_threshold, "rpkm").otherwise("included")
    return x.select("id", reason.alias("reason"))


def in_bounds(genes: DataFrame, lengths: DataFrame, outside: int) -> DataFrame:
    """Genes whose windows stay within their contig, in lengths(chrom, length)."""
    x = genes.join(lengths, "chrom")
    return x.where((F.col("f_start0") - outside >= 0) & (F.col("f_stop0") + outside < F.col("length"))).drop("length")
