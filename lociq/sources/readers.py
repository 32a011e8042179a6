"""Readers. Coordinates become 0-based closed; tables keep their column names."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import binning
from . import schemas


def _tsv(spark: SparkSession, path: str, schema: str, header: bool = False, sep: str = "\t") -> DataFrame:
    return spark.read.csv(path, schema=schema, sep=sep, header=header, comment="#", quote="", nullValue="")


def samples(spark: SparkSession, path: str) -> DataFrame:
    """Sample sheet: all text, # lines skipped."""
    return spark.read.csv(path, schema=schemas.SAMPLES, sep="\t", header=True, comment="#")


def gff(spark: SparkSession, path: str) -> DataFrame:
    """GFF3, GFF2 or GTF rows, with start0 and stop0 beside the file's columns. Only whole lines are comments. Sequences after ##FASTA aren't rows."""
    # Their lines have no third column, and no place's name begins with >.
    return _tsv(spark, path, schemas.GFF).where(F.col("feature").isNotNull() & ~F.col("seq").startswith(">")).withColumn("start0", F.col("start") - 1).withColumn("stop0", F.col("stop") - 1)


def is_gtf(rows: DataFrame) -> Column:
    """Whether an attribute list is written as in GTF."""
    return rows["attributes"].rlike(r'^\s*[A-Za-z0-9_]+ "')


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """chrom (first word of the header), seq: a row a record. Only a > that begins a line begins a record."""
    x = spark.read.option("lineSep", "\n>").text(path).where(F.trim("value") != "")
    x = x.select(F.regexp_replace("value", "^>", "").alias("value"))
    head = F.split_part("value", F.lit("\n"), F.lit(1))
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "")
    return x.select(F.regexp_extract(head, r"^\s*(\S+)", 1).alias("chrom"), body.alias("seq"))


def fasta_lengths(spark: SparkSession, path: str) -> DataFrame:
    return fasta(spark, path).select("chrom", F.length("seq").cast("long").alias("length"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, quality of reads of four lines; a file that isn't made of these raises.

    Records are split at lines that begin with @. A quality line may begin so too: then a part of three lines is followed by one of
    a single line, the rest of its quality. Only such parts are ordered within their file to be put together. A read may have no bases.
    """
    x = spark.read.option("lineSep", "\n@").text(path)
    text = F.regexp_replace("value", r"\r(?=\n|$)", "")
    bare = F.regexp_replace(text, r"\n+$", "")
    text = F.when(text.rlike(r"\A[^\n]*\n\n\+[^\n]*\n*\z"), F.concat(bare, F.lit("\n"))).otherwise(bare)  # no bases: the fourth line is empty
    x = x.select(text.alias("text"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("i"))
    x = x.withColumn("lines", F.when(F.col("text") == "", 1).otherwise(F.size(F.split("text", "\n"))))
    first = (F.col("block") == 0) & F.col("text").startswith("@")
    whole = x.where("lines > 3").select(F.when(first, F.substr("text", F.lit(2))).otherwise(F.col("text")).alias("text"))
    along = Window.partitionBy("file").orderBy("block", "i")
    parts = x.where("lines <= 3").withColumn("next", F.lead("text").over(along)).withColumn("next_lines", F.lead("lines").over(along)).withColumn("before", F.lag("lines").over(along))
    rest = F.when(F.col("next_lines") == 1, F.concat_ws("\n@", "text", "next")).otherwise(F.raise_error(F.concat(F.lit("not a read of four lines: "), "text")))
    stray = (F.col("lines") == 1) & (F.coalesce("before", F.lit(0)) != 3) & (F.col("text") != "")
    joined = parts.where((F.col("lines") > 1) | stray).select(F.regexp_replace(rest, "^@", "").alias("text"))
    line = F.split("text", "\n")
    out = whole.unionByName(joined).select(F.split_part(line[0], F.lit(" "), F.lit(1)).alias("id"), line[1].alias("seq"), line[2].alias("plus"), line[3].alias("quality"), F.size(line).alias("lines"))
    fits = (F.col("lines") == 4) & F.col("plus").startswith("+") & (F.length("seq") == F.length("quality"))
    return out.select("id", F.when(fits, F.col("seq")).otherwise(F.raise_error(F.concat(F.lit("not a read of four lines: "), "id"))).alias("seq"), "quality")


def cigar_span(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers."""
    n = F.regexp_extract_all(cigar, F.lit("([0-9]+)[MDN=X]"), F.lit(1))
    return F.aggregate(n, F.lit(0).cast("long"), lambda a, b: a + b.cast("long"))


def sam(spark: SparkSession, path: str | DataFrame) -> DataFrame:
    """Alignments: end0 (exclusive) by CIGAR, stop0 by the read's length; nh is 1 without the tag; unmapped reads keep null places.

    path: of the files, or their lines as value beside other columns, which stay.
    """
    x = (spark.read.text(path) if isinstance(path, str) else path).where(~F.col("value").startswith("@") & (F.col("value") != ""))
    f = F.split("value", "\t")
    flag = f[1].cast("int")
    start = F.when(flag.bitwiseAND(F.lit(4)) == 0, f[3].cast("long") - 1)
    length = F.when(f[9] == "*", F.lit(0)).otherwise(F.length(f[9])).cast("long")
    nh = F.coalesce(F.nullif(F.regexp_extract("value", r"\tNH:i:([0-9]+)", 1), F.lit("")).cast("int"), F.lit(1))
    return x.select(
        f[0].alias("read_id"), flag.alias("flag"), F.nullif(f[2], F.lit("*")).alias("chrom"), start.alias("start0"), (start + cigar_span(f[5])).alias("end0"), (start + length - 1).alias("stop0"),
        f[4].cast("int").alias("mapq"), length.alias("read_length"), nh.alias("nh"), F.when(flag.bitwiseAND(F.lit(16)) != 0, "-").otherwise("+").alias("strand"),
        *[c for c in x.columns if c != "value"],
    )


def track_strand(flag: Column) -> Column:
    """Forward for reads on their strand, and for second reads of pairs on the other."""
    reverse, second = flag.bitwiseAND(F.lit(16)) != 0, flag.bitwiseAND(F.lit(128)) != 0
    return F.when((~reverse & ~second) | (reverse & second), "+").otherwise("-")


def alignments_of(spark: SparkSession, folder: str) -> DataFrame:
    """All SAM and BAM files of a folder, with library: the file's name without its ending."""
    from .bam import BamSource

    x = sam(spark, spark.read.option("pathGlobFilter", "*.[sS][aA][mM]").text(folder).select("value", F.col("_metadata.file_name").alias("file")))
    spark.dataSource.register(BamSource)
    chosen = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    x = x.unionByName(spark.read.format("bam").option("push_filters", chosen).load(folder))
    return x.withColumn("library", F.regexp_replace("file", r"\.[^.]*$", "")).drop("file")


def in_region(alignments: DataFrame, chrom: str, start0: int, stop0: int) -> DataFrame:
    """Alignments that touch the closed region. Over sinks.alignments' layout only the chromosome's files, and in these the row groups of the region's
    bins, are read; other tables are filtered by place."""
    hit = (F.col("chrom") == chrom) & (F.col("start0") <= stop0) & (F.col("end0") > start0)
    if "region_bin" in alignments.columns:
        hit = hit & binning.in_bins(F.col("region_bin"), binning.bins_of_region(start0, stop0))
    return alignments.where(hit)


def bed(spark: SparkSession, path: str) -> DataFrame:
    x = _tsv(spark, path, schemas.BED6)
    return x.select("chrom", F.col("start").alias("start0"), (F.col("stop") - 1).alias("stop0"), "name", "score", "strand")


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    x = _tsv(spark, path, schemas.BEDGRAPH).where("chrom not like 'track%' and chrom not like 'browser%'")
    return x.select("chrom", F.col("start").alias("start0"), (F.col("stop") - 1).alias("stop0"), "value")


def totals(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, schemas.TOTALS)


def predictions_a(spark: SparkSession, path: str) -> DataFrame:
    return _tsv(spark, path, schemas.PREDICTIONS_A, header=True)


def predictions_b(spark: SparkSession, path: str) -> DataFrame:
    """Rows with a rank only: 999999 stands for none."""
    x = spark.read.csv(path, schema=schemas.PREDICTIONS_B, header=True)
    return x.where((F.col("SS_pred_rank") != 999999) & F.col("pred").isNotNull())


def de_table(spark: SparkSession, path: str, schema: str, index_header: bool = False) -> DataFrame:
    """Differential results. index_header: the header lacks the name of the first column, and the file may be empty."""
    if not index_header:
        return spark.read.csv(path, schema=schema, header=True, nanValue="NaN", nullValue="NA")
    first = schema.split(",")[1].split()[0].strip("`")
    x = spark.read.csv(path, schema=schema, sep="\t", nullValue="NA", mode="PERMISSIVE")
    return x.where(F.col(schema.split()[0]) != first)


def feature_counts(spark: SparkSession, path: str, libraries: list[str]) -> DataFrame:
    """Counts of an external counter, long: id, chrom, start, stop, strand, length, library, cnt. ;-lists of places are taken apart."""
    wide = ", ".join(f"`{x}` double" for x in libraries)
    x = _tsv(spark, path, f"id string, chrom string, start string, stop string, strand string, length bigint, {wide}").where("id <> 'Geneid'")
    parts = F.arrays_zip(*[F.split(c, ";").alias(c) for c in ("chrom", "start", "stop", "strand")])
    x = x.withColumn("p", F.explode(parts)).select("id", "p.chrom", F.col("p.start").cast("long").alias("start"), F.col("p.stop").cast("long").alias("stop"), "p.strand", "length", *[F.col(f"`{c}`") for c in libraries])
    return x.unpivot(["id", "chrom", "start", "stop", "strand", "length"], [F.col(f"`{c}`") for c in libraries], "library", "cnt")


def sheet(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A sheet of a folder that sinks.sheets has written; only its files are read."""
    return spark.read.parquet(path).where(F.col("sheet") == name).drop("sheet")
