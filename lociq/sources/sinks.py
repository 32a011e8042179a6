"""Writers. Big outputs are written in parallel parts; a header line needs one part and is for report-sized tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import attributes
from ..operators import binning, coverage


def gff3(df: DataFrame, path: str) -> None:
    """Rows with schemas.GFF's columns (attributes as a list or a map), sorted by place, under the version line.

    Files are ranges of places, in the order of their names; the version line begins the first.
    """
    attrs = attributes.written("attributes") if dict(df.dtypes)["attributes"].startswith("map") else F.col("attributes")
    columns = [F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in ("seq", "source", "feature", "start", "stop", "score", "strand", "phase")]
    rows = df.select(F.lit(1).alias("k"), F.col("seq").alias("s"), F.col("start").alias("a"), F.col("stop").alias("b"), F.concat_ws("\t", *columns, attrs).alias("value"))
    head = df.sparkSession.sql("select 0 as k, '' as s, 0L as a, 0L as b, '##gff-version 3' as value")
    head.unionByName(rows).repartitionByRange("k", "s", "a", "b").sortWithinPartitions("k", "s", "a", "b", "value").select("value").write.text(path)


def tsv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.csv(path, sep="\t", header=header, quote="", emptyValue="")


def sheets(df: DataFrame, path: str, sheet: str = "sheet") -> None:
    """A folder of Parquet files for each sheet (readers.sheet). Large sheets are several files."""
    df.hint("rebalance", sheet).write.partitionBy(sheet).parquet(path)


def wiggle(tracks: DataFrame, path: str) -> None:
    """variableStep text, in folders by library and strand. Files are ranges of places in the order of their names; the track line begins the first of a folder."""
    blocks = coverage.wiggle(tracks).select("library", "strand", F.lit(1).alias("k"), "chrom", "part", F.col("block").alias("value"))
    name = F.concat(F.lit('track type=wiggle_0 name="'), F.col("library"), F.lit(" "), F.col("strand"), F.lit('"'))
    heads = tracks.select("library", "strand").distinct().select("library", "strand", F.lit(0).alias("k"), F.lit("").alias("chrom"), F.lit(0).cast("long").alias("part"), name.alias("value"))
    keys = ["library", "strand", "k", "chrom", "part"]
    x = heads.unionByName(blocks).repartitionByRange(*keys).sortWithinPartitions(*keys)
    x.select("library", "strand", "value").write.partitionBy("library", "strand").text(path)


def bedgraph(runs: DataFrame, path: str, value: str = "depth") -> None:
    """chrom, start, stop (half-open), value, sorted by place within each file; files are ranges of places."""
    x = runs.select("chrom", F.col("start0").alias("start"), (F.col("stop0") + 1).alias("stop"), value)
    x.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.csv(path, sep="\t")


def bed6(features: DataFrame, path: str) -> None:
    """Annotation rows but genes, as half-open BED."""
    x = features.where(F.lower("feature") != "gene").select("chrom", F.col("f_start0").alias("start"), (F.col("f_stop0") + 1).alias("stop"), F.col("id").alias("name"), F.lit("0").alias("score"), "strand")
    x.repartitionByRange("chrom", "start").sortWithinPartitions("chrom", "start").write.csv(path, sep="\t")


def alignments(reads: DataFrame, path: str, rows: int = 1_000_000) -> None:
    """Reads in folders by chromosome, in files of at most `rows` rows that are sorted by bin, then place.

    region_bin is the smallest bin of a hierarchy that holds the alignment, so a region's alignments, long ones included, lie in a handful of bins
    and of row groups (readers.in_region).
    """
    x = reads.withColumn("region_bin", binning.bin_of(F.col("start0"), F.greatest("start0", F.col("end0") - 1)))
    keys = ["chrom", "region_bin", "start0", "stop0"]
    # Row groups of a few MB, so that statistics tell places apart.
    writer = x.repartitionByRange(*keys).sortWithinPartitions(*keys).write.partitionBy("chrom")
    writer.option("maxRecordsPerFile", rows).option("parquet.block.size", 1 << 23).parquet(path)


def count_matrix(counts: DataFrame, path: str, libraries: list[str]) -> None:
    """id and a column a library, - as _ in names, as CSV."""
    x = counts.groupBy("id").pivot("library", libraries).agg(F.sum("cnt"))
    x.select("id", *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c.replace("-", "_")) for c in libraries]).write.csv(path, header=True)
