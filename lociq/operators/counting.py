"""Reads in features: the ways of counting, totals, and tables of counts.

Reads have chrom, strand, start0, stop0, read_length, nh, flag, library and n, how many equal reads a row stands for.
Features have id, feature, chrom, strand, f_start0, f_stop0.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_join, runs_of_depth

READ = ["library", "chrom", "strand", "start0", "stop0", "read_length", "nh", "flag"]


def collapsed(reads: DataFrame) -> DataFrame:
    """Equal reads as one row with their number: less to join and to shuffle."""
    return reads.groupBy(*READ).agg(F.sum("n").alias("n"))


def mapped() -> Column:
    return (F.col("flag").bitwiseAND(F.lit(4))) == 0


def accepted() -> Column:
    """Mapped once or not counted."""
    return (F.col("nh") <= 1) & mapped()


def overlaps(reads: DataFrame, features: DataFrame, stranded: bool = True) -> DataFrame:
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    f = features if stranded else features.withColumnRenamed("strand", "f_strand")
    return overlap_join(reads, f, keys, ("start0", "stop0"), ("f_start0", "f_stop0"))


def looked_up(reads: DataFrame, features: DataFrame, stranded: bool, chosen: Callable[[Column], Column], size: int = 512, most: int = 256) -> tuple[DataFrame, DataFrame | None]:
    """Reads with each element of what `chosen` makes of the array of features (feature, id, f_start0, f_stop0) that they overlap, as x; and the reads that must take the general join.

    Features are listed in the bins that they touch and the one behind, so a read of at most `size` bases looks into the list of its last base's bin only: it's one row, which is
    shuffled once and not sorted, and all its features are at hand without a row a pair. Longer reads, and those in bins of more than `most` features, take the general
    join; None where there are none.
    """
    keys = ["chrom", "strand"] if stranded else ["chrom"]
    a, b = F.col("f_start0"), F.col("f_stop0")
    entry = F.struct("feature", "id", "f_start0", "f_stop0")
    f = features.where(b >= a).select(*keys, entry.alias("__x"), F.explode(F.sequence(F.floor(a / size), F.floor(b / size) + 1)).alias("__bin"))
    f = f.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "__bin")))
    lists = f.where(F.col("__n") <= most).groupBy(*keys, "__bin").agg(F.collect_list("__x").alias("__f"))
    crowded = f.where(F.col("__n") > most).select(*keys, "__bin").distinct()
    first, last = F.col("start0"), F.col("stop0")
    hit = F.filter("__f", lambda x: (x["f_start0"] <= last) & (x["f_stop0"] >= first))
    at = reads.where((last - first).between(0, size - 1)).withColumn("__bin", F.floor(last / size))
    # Within transform the hits are found once, however often `chosen` names them.
    found = at.join(lists.hint("shuffle_hash"), [*keys, "__bin"]).select(*reads.columns, F.explode(F.transform(F.array(hit), chosen)[0]).alias("x"))
    wide, rest = reads.where(last - first >= size), None
    if not wide.isEmpty():
        rest = wide
    if not crowded.isEmpty():
        held = at.join(crowded, [*keys, "__bin"], "left_semi").select(*reads.columns)
        rest = held if rest is None else rest.unionByName(held)
    return found, rest


def of_kind(hits: Column, x: Column) -> Column:
    """How many of a read's features are of x's kind."""
    return F.size(F.filter(hits, lambda y: y["feature"].eqNullSafe(x["feature"])))


def count_all_overlaps(reads: DataFrame, features: DataFrame, stranded: bool = True, multi: bool = False, fraction: bool = False) -> DataFrame:
    """feature, id, library, cnt: each read counts for every feature it overlaps.

    multi keeps reads that map to several places; fraction divides by these and by the features of its kind that it overlaps.
    """
    reads = reads if multi else reads.where("nh <= 1")
    if not fraction:
        found, rest = looked_up(reads.select(*READ[:5], "n"), features, stranded, lambda h: h)
        pairs = found.select("x.feature", "x.id", "library", "n")
        if rest is not None:
            pairs = pairs.unionByName(overlaps(rest, features, stranded).select(*pairs.columns))
        return pairs.groupBy("feature", "id", "library").agg(F.sum("n").cast("double").alias("cnt"))
    places = F.col("nh") if multi else F.lit(1)
    found, rest = looked_up(reads, features, stranded, lambda h: F.transform(h, lambda x: F.struct(x["feature"], x["id"], of_kind(h, x).alias("hits"))))
    pairs = found.select("x.feature", "x.id", "library", (F.col("n") / (F.col("x.hits") * places)).alias("share"))
    if rest is not None:
        # Features are counted for each kind of read, which must be one row then.
        hits = F.count(F.lit(1)).over(Window.partitionBy(*READ, "feature"))
        pairs = pairs.unionByName(overlaps(collapsed(rest), features, stranded).withColumn("share", F.col("n") / (hits * places)).select(*pairs.columns))
    return pairs.groupBy("feature", "id", "library").agg(F.sum("share").alias("cnt"))


def count_single_hits(reads: DataFrame, features: DataFrame, stranded: bool = False) -> DataFrame:
    """feature, id, library, cnt: only reads that overlap one feature of their kind."""
    found, rest = looked_up(reads.select(*READ[:5], "n"), features, stranded, lambda h: F.filter(h, lambda x: of_kind(h, x) == 1))
    pairs = found.select("x.feature", "x.id", "library", "n")
    if rest is not None:
        own = READ[:5]
        rest = rest.groupBy(*own).agg(F.sum("n").alias("n"))
        hits = F.count(F.lit(1)).over(Window.partitionBy(*own, "feature"))
        pairs = pairs.unionByName(overlaps(rest, features, stranded).withColumn("hits", hits).where("hits = 1").select(*pairs.columns))
    return pairs.groupBy("feature", "id", "library").agg(F.sum("n").cast("double").alias("cnt"))


def in_style(style: str, start: Column, stop: Column) -> Column:
    """Whether the read counts for the closed span by its mapping style."""
    fwd = F.col("strand") == "+"
    five, three = F.when(fwd, F.col("start0")).otherwise(F.col("stop0")), F.when(fwd, F.col("stop0")).otherwise(F.col("start0"))
    point = {"fiveprime": five, "threeprime": three, "centered": F.bround((F.col("start0") + F.col("stop0")) / 2).cast("long")}
    if style == "global":
        return (F.col("start0") <= stop) & (F.col("stop0") >= start)
    if style not in point:
        raise ValueError(style)
    return point[style].between(start, stop)


def count_by_style(reads: DataFrame, genes: DataFrame, style: str) -> DataFrame:
    """id, library-free count of accepted reads by mapping style; genes without reads have 0."""
    pairs = overlaps(reads.where(accepted()), genes).where(in_style(style, F.col("f_start0"), F.col("f_stop0")))
    counts = pairs.groupBy("id").agg(F.sum("n").alias("cnt"))
    return genes.select("id").join(counts, "id", "left").select("id", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def outside(reads: DataFrame, mask: DataFrame, size: int = 4096) -> DataFrame:
    """Reads that overlap no masked feature, on whichever strand; rows with a null chrom or end overlap none.

    The mask becomes disjoint stretches, listed in the bins that they touch and the one behind, so a read of at most `size` bases looks into the list of its last base's bin
    only: it's neither entered in several bins nor joined twice. A list has at most as many stretches as a bin has bases. Longer reads take the general join.
    """
    m = mask.select("chrom", F.col("f_start0").alias("m0"), F.col("f_stop0").alias("m1"), F.lit(1).cast("long").alias("w"))
    m = runs_of_depth(m.where("m1 >= m0"), ["chrom"], ("m0", "m1"), "w").select("chrom", F.col("start0").alias("m0"), F.col("stop0").alias("m1"))
    bins = F.explode(F.sequence(F.floor(F.col("m0") / size), F.floor(F.col("m1") / size) + 1))
    lists = m.withColumn("__bin", bins).groupBy("chrom", "__bin").agg(F.collect_list(F.struct("m0", "m1")).alias("__m"))
    wide = F.coalesce(F.col("stop0") - F.col("start0") >= size, F.lit(False))
    short = reads.where(~wide).withColumn("__bin", F.floor(F.col("stop0") / size)).join(lists, ["chrom", "__bin"], "left")
    hit = F.exists("__m", lambda x: (x["m0"] <= F.col("stop0")) & (x["m1"] >= F.col("start0")) & (F.col("stop0") >= F.col("start0")))
    kept = short.where(~F.coalesce(hit, F.lit(False))).select(*reads.columns)
    return kept.unionByName(overlap_join(reads.where(wide), m, ["chrom"], ("start0", "stop0"), ("m0", "m1"), how="left_anti"))


def totals(reads: DataFrame) -> DataFrame:
    """library, chrom, n, avg_len: mapped alignments, and their mean length."""
    return reads.where(mapped()).groupBy("library", "chrom").agg(F.sum("n").alias("n"), (F.sum(F.col("read_length") * F.col("n")) / F.sum("n")).alias("avg_len"))


def length_histogram(reads: DataFrame, lengths: list[int] | None = None) -> DataFrame:
    """chrom, library, read_length, cnt with a 0 where a length that is seen elsewhere, or in lengths, isn't."""
    counts = reads.groupBy("chrom", "library", "read_length").agg(F.sum("n").alias("cnt"))
    grid = F.array(*[F.lit(x).cast("long") for x in lengths]) if lengths else counts.agg(F.collect_set("read_length")).scalar()  # a value a length
    filled = counts.select("chrom", "library").distinct().withColumn("read_length", F.explode(grid))
    return filled.join(counts, ["chrom", "library", "read_length"], "left").select("chrom", "library", "read_length", F.coalesce("cnt", F.lit(0)).alias("cnt"))


def length_fractions(histogram: DataFrame) -> DataFrame:
    total = F.sum("cnt").over(Window.partitionBy("chrom", "library"))
    return histogram.withColumn("fraction", F.when(total > 0, F.col("cnt") / total).otherwise(F.lit(0.0)))


def rpkm(counts: Column, total: Column, length: Column) -> Column:
    """Reads per kilobase and million, 0 where there is no total or length, to two places."""
    return F.round(F.when((total > 0) & (length > 0), counts * 1e9 / (total.cast("double") * length)).otherwise(F.lit(0.0)), 2)


def rpkm_table(reads: DataFrame, genes: DataFrame) -> DataFrame:
    """id, library, cnt, rpkm of every gene and library that has reads on its chromosome."""
    counts = count_all_overlaps(reads, genes)
    total = reads.where(mapped()).groupBy("library", "chrom").agg(F.sum("n").alias("total"))
    every = genes.join(total, "chrom").select("id", "library", "total", (F.col("f_stop0") - F.col("f_start0") + 1).alias("length"))
    out = every.join(counts.select("id", "library", "cnt"), ["id", "library"], "left")
    cnt = F.coalesce("cnt", F.lit(0.0))
    return out.select("id", "library", cnt.alias("cnt"), rpkm(cnt, F.col("total"), F.col("length")).alias("rpkm"))


def on_annotation(annotation: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    """Annotation rows with their counts, 0 without any; of counts that repeat, the largest."""
    one = counts.groupBy(*keys).agg(F.max("cnt").alias("cnt"))
    return annotation.join(one, keys, "left").withColumn("cnt", F.coalesce("cnt", F.lit(0.0)))


def on_loci(annotation: DataFrame, counts: DataFrame, order: str, keys: tuple[str, ...] = ("feature", "chrom", "start1", "stop1", "strand")) -> DataFrame:
    """Annotation rows with the counts of their feature and place, 0 without any; of counts that repeat, the last by order."""
    one = counts.groupBy(*keys).agg(F.max_by("cnt", order).alias("cnt"))
    return annotation.join(one, list(keys), "left").withColumn("cnt", F.coalesce("cnt", F.lit(0.0)))


def counted_features(features: DataFrame) -> DataFrame:
    """What differential tools are given: all features but genes and pseudogenes, which repeat their parts."""
    return features.where(~F.lower("feature").isin("gene", "pseudogene"))


def read_table(counts: DataFrame, classes: dict[str, str]) -> DataFrame:
    """class, library-free totals: features and reads of each class, and of all; classes without rows have 0."""
    spark = counts.sparkSession
    dim = spark.createDataFrame(list(classes.items()), "feature string, class string")
    x = counts.join(F.broadcast(dim), "feature", "left").withColumn("class", F.coalesce("class", F.lit("misc")))
    rolled = x.rollup("class").agg(F.countDistinct("id").alias("features"), F.round(F.sum("cnt"), 2).alias("reads"), F.grouping("class").alias("g"))
    rolled = rolled.select(F.when(F.col("g") == 1, F.lit("total")).otherwise(F.col("class")).alias("class"), "features", "reads")
    names = spark.createDataFrame([(c,) for c in sorted({*classes.values(), "misc", "total"})], "class string")
    return names.join(rolled, "class", "left").select("class", F.coalesce("features", F.lit(0)).alias("features"), F.coalesce("reads", F.lit(0.0)).alias("reads"))


def keep_first(df: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key by a total order."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__rn = 1").drop("__rn")


def mean_overlap(reads: DataFrame, features: DataFrame) -> DataFrame:
    """id, library, avg_overlap: mean length of the overlaps of reads with the feature."""
    size = F.least("stop0", "f_stop0") - F.greatest("start0", "f_start0") + 1
    pairs = overlaps(reads, features).withColumn("size", size)
    return pairs.groupBy("id", "library").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("avg_overlap"))
