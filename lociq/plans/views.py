"""Interval tables derived from the star-schema test tables, as DataFrames and as SQL for the oracle."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = {"CDS": "CDS", "gene": "gene", "rRNA": "rRNA", "tRNA": "tRNA", "sRNA": "sRNA", "ncRNA": "ncRNA"}
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTACACGTACGTACGTACGTACGTACGTAC")


#: Letters of a read, and the qualities that small and capital letters stand for.
PIECE, QUALITIES = 100, "".join(chr(48 + 9 * i % 26) for i in range(26)) + "+" * 26


def _table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def reads(spark: SparkSession, d: str) -> DataFrame:
    """Alignments: a row each."""
    fwd, length = F.col("l_linestatus") == "F", 20 + F.col("l_quantity").cast("long")
    start = F.col("l_partkey") * 10 + F.col("l_linenumber")
    x = _table(spark, d, "lineitem").select(
        F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")).alias("chrom"), F.when(fwd, "+").otherwise("-").alias("strand"), start.alias("start0"), (start + length - 1).alias("stop0"),
        length.alias("read_length"), (1 + F.col("l_orderkey") % 3).alias("nh"), F.when(fwd, 0).otherwise(16).alias("flag"), F.when(F.col("l_orderkey") % 2 == 0, "RIBO").otherwise("RNA").alias("method"),
        F.col("l_returnflag").alias("cond"), (1 + F.col("l_linenumber") % 2).cast("string").alias("rep"), F.lit(1).cast("long").alias("n"),
    )
    return x.withColumn("library", F.concat_ws("-", "method", "cond", "rep"))


def annotation(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey")
    name = lambda x: F.concat(F.lit("f"), x.cast("string"))
    tag = F.when(k % 3 == 0, F.concat(F.lit(";locus_tag="), F.col("p_brand"))).otherwise("")
    feature = F.when(F.col("p_type") == "STANDARD", "CDS").when(F.col("p_type") == "SMALL", "sRNA").when(F.col("p_type") == "LARGE", "rRNA").when(F.col("p_type") == "ECONOMY", "tRNA").when(F.col("p_type") == "MEDIUM", "gene").otherwise("ncRNA")
    return _table(spark, d, "part").select(
        k.alias("k"), name(k).alias("id"), F.when(k % 10 != 0, name(k - k % 10)).when(k % 100 != 0, name(k - k % 100)).alias("parent"), F.concat(F.lit("chr"), (k % 5).cast("string")).alias("chrom"), feature.alias("feature"),
        (k * 10 + 1).alias("start1"), (k * 10 + 6 * F.col("p_size").cast("long")).alias("stop1"), F.when(F.col("p_size") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.concat(F.lit("ID=f"), k.cast("string"), F.lit(";Name="), "p_name", tag, F.lit(";")).alias("attributes"), F.when(k % 3 == 0, F.col("p_brand")).alias("locus_tag"),
    )


def features(spark: SparkSession, d: str) -> DataFrame:
    """Annotation rows as closed 0-based spans."""
    return annotation(spark, d).select("id", "feature", "chrom", "strand", (F.col("start1") - 1).alias("f_start0"), (F.col("stop1") - 1).alias("f_stop0"), "locus_tag")


def genome(spark: SparkSession, d: str) -> DataFrame:
    return _table(spark, d, "documents").select("doc_id", F.regexp_replace(F.translate("text", *LETTERS), "[^ACGT]", "").alias("seq"))


def fastq(spark: SparkSession, d: str) -> DataFrame:
    """Reads: pieces of the texts, with qualities by their letters."""
    at = F.sequence(F.lit(0), F.length("text") - 1, F.lit(PIECE))
    x = _table(spark, d, "documents").where(F.length("text") > 0).select("doc_id", "text", F.explode(at).alias("i"))
    piece = F.substring(F.col("text"), F.col("i") + 1, F.lit(PIECE))
    seq = F.regexp_replace(F.translate(piece, *LETTERS), "[^ACGT]", "N")
    quality = F.translate(F.regexp_replace(piece, "[^A-Za-z]", "#"), LETTERS[0], QUALITIES)
    return x.select(F.concat_ws("-", "doc_id", "i").alias("id"), seq.alias("seq"), quality.alias("quality"))


def pairs(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The first and the last 60 bases of each read, the last as read from the other strand."""
    x = fastq(spark, d)
    mate = F.reverse(F.translate(F.substring("seq", 41, 60), "ACGT", "TGCA"))
    return x.select("id", F.substring("seq", 1, 60).alias("seq"), F.substring("quality", 1, 60).alias("quality")), x.select("id", mate.alias("seq"), F.reverse(F.substring("quality", 41, 60)).alias("quality"))


def predictions(spark: SparkSession, d: str) -> DataFrame:
    orders = _table(spark, d, "orders")
    x = orders.join(annotation(spark, d), F.col("o_custkey") == F.col("k"))
    return x.select(
        "chrom", "start1", (F.col("stop1") + F.when(F.col("o_custkey") % 4 == 0, 3).otherwise(0)).alias("stop1"), "strand", F.col("o_orderstatus").alias("cond"), (1 + F.col("o_orderkey") % 2).alias("rep"),
        (F.col("o_totalprice") / 1000 - 200).alias("pred"), F.when(F.col("o_orderpriority") == "1-URGENT", -1).otherwise(0).alias("dist"), "o_orderkey",
    )


def de_results(spark: SparkSession, d: str) -> DataFrame:
    x = _table(spark, d, "events").join(annotation(spark, d), F.col("user_id") == F.col("k"))
    return x.select("id", "chrom", "start1", "stop1", "strand", F.col("event_type").alias("contrast"), F.round(F.col("value") / 50 - 2, 6).alias("log2fc"), ((F.col("event_id") % 1000) / 1000).alias("padj"), "event_id")


SQL = {
    "reads": """SELECT concat('chr', cast(l_suppkey % 5 AS VARCHAR)) AS chrom, CASE WHEN l_linestatus = 'F' THEN '+' ELSE '-' END AS strand,
        l_partkey * 10 + l_linenumber AS start0, l_partkey * 10 + l_linenumber + 19 + cast(l_quantity AS BIGINT) AS stop0, 20 + cast(l_quantity AS BIGINT) AS read_length,
        1 + l_orderkey % 3 AS nh, CASE WHEN l_linestatus = 'F' THEN 0 ELSE 16 END AS flag, CASE WHEN l_orderkey % 2 = 0 THEN 'RIBO' ELSE 'RNA' END AS method,
        l_returnflag AS cond, cast(1 + l_linenumber % 2 AS VARCHAR) AS rep,
        concat(CASE WHEN l_orderkey % 2 = 0 THEN 'RIBO' ELSE 'RNA' END, '-', l_returnflag, '-', cast(1 + l_linenumber % 2 AS VARCHAR)) AS library FROM lineitem""",
    "annotation": """SELECT p_partkey AS k, concat('f', cast(p_partkey AS VARCHAR)) AS id,
        CASE WHEN p_partkey % 10 <> 0 THEN concat('f', cast(p_partkey - p_partkey % 10 AS VARCHAR)) WHEN p_partkey % 100 <> 0 THEN concat('f', cast(p_partkey - p_partkey % 100 AS VARCHAR)) END AS parent,
        concat('chr', cast(p_partkey % 5 AS VARCHAR)) AS chrom,
        CASE p_type WHEN 'STANDARD' THEN 'CDS' WHEN 'SMALL' THEN 'sRNA' WHEN 'LARGE' THEN 'rRNA' WHEN 'ECONOMY' THEN 'tRNA' WHEN 'MEDIUM' THEN 'gene' ELSE 'ncRNA' END AS feature,
        p_partkey * 10 + 1 AS start1, p_partkey * 10 + 6 * cast(p_size AS BIGINT) AS stop1, CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand,
        concat('ID=f', cast(p_partkey AS VARCHAR), ';Name=', p_name, CASE WHEN p_partkey % 3 = 0 THEN concat(';locus_tag=', p_brand) ELSE '' END, ';') AS attributes, p_name, p_brand,
        CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS locus_tag FROM part""",
    "features": "SELECT id, feature, chrom, strand, start1 - 1 AS f_start0, stop1 - 1 AS f_stop0, locus_tag FROM annotation",
    "cds": "SELECT * FROM features WHERE feature = 'CDS'",
    "genome": f"SELECT doc_id, regexp_replace(translate(text, '{LETTERS[0]}', '{LETTERS[1]}'), '[^ACGT]', '', 'g') AS seq FROM documents",
    "fastq": f"""SELECT concat(doc_id, '-', i) AS id, regexp_replace(translate(piece, '{LETTERS[0]}', '{LETTERS[1]}'), '[^ACGT]', 'N', 'g') AS seq, translate(regexp_replace(piece, '[^A-Za-z]', '#', 'g'), '{LETTERS[0]}', '{QUALITIES}') AS quality
        FROM (SELECT doc_id, i, substring(text, i + 1, {PIECE}) AS piece FROM (SELECT doc_id, text, unnest(range(0, len(text), {PIECE})) AS i FROM documents))""",
    "predictions": """SELECT a.chrom, a.start1, a.stop1 + CASE WHEN o_custkey % 4 = 0 THEN 3 ELSE 0 END AS stop1, a.strand, o_orderstatus AS cond, 1 + o_orderkey % 2 AS rep,
        o_totalprice / 1000 - 200 AS pred, CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE 0 END AS dist, o_orderkey FROM orders JOIN annotation a ON a.k = o_custkey""",
    "de_results": """SELECT a.id, a.chrom, a.start1, a.stop1, a.strand, event_type AS contrast, round(value / 50 - 2, 6) AS log2fc, (event_id % 1000) / 1000 AS padj, event_id
        FROM events JOIN annotation a ON a.k = user_id""",
    "totals": "SELECT library, chrom, count(*) AS n, avg(read_length) AS avg_len FROM reads WHERE flag & 4 = 0 GROUP BY ALL",
    "counts": """SELECT id, library, cast(count(*) AS DOUBLE) AS cnt FROM reads r JOIN cds f ON r.chrom = f.chrom AND r.strand = f.strand AND start0 <= f_stop0 AND stop0 >= f_start0 WHERE nh <= 1 GROUP BY ALL""",
    "rpkm": """SELECT f.id, t.library, coalesce(c.cnt, 0) AS cnt, round(coalesce(c.cnt, 0) * 1e9 / (cast(t.n AS DOUBLE) * (f_stop0 - f_start0 + 1)), 2) AS rpkm
        FROM cds f JOIN totals t ON f.chrom = t.chrom LEFT JOIN counts c ON c.id = f.id AND c.library = t.library""",
}


def with_views(sql: str) -> str:
    """The SQL with the views before it."""
    views = ", ".join(f"{k} AS ({v})" for k, v in SQL.items())
    return f"WITH RECURSIVE {views}" + (", " + sql[5:] if sql.startswith("WITH ") else " " + sql)
