"""Annotation rows: parents, conversion, enrichment, masks."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import attributes as A
from ..tables import stored


def one_row_an_id(df: DataFrame, id_col: str, parent_col: str) -> DataFrame:
    return df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(parent_col).alias("up"))


def roots(df: DataFrame, id_col: str = "id", parent_col: str = "parent", most_rounds: int = 40) -> DataFrame:
    """id, root, depth: the furthest ancestor that exists, by doubling the distance climbed each round.

    A row an id, however often it repeats (a feature in segments has one id); of several parents the first by name counts. A missing
    parent ends the climb. Cycles don't end it: they raise. Rows without an id are left out.
    """
    ids = one_row_an_id(df, id_col, parent_col)
    known = ids.select(F.col("id").alias("up"), F.lit(True).alias("there"))
    now = ids.join(known, "up", "left").select("id", F.when(F.col("there"), F.col("up")).alias("up"), F.when(F.col("there"), 1).otherwise(0).cast("long").alias("depth"))
    for _ in range(most_rounds):
        now = stored(now)
        if now.where("up is not null").isEmpty():
            break
        more = now.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("further"))
        now = now.join(more, "up", "left")
        if now.where("next is not null").isEmpty():
            break
        now = now.select("id", F.coalesce("next", "up").alias("up"), (F.col("depth") + F.coalesce("further", F.lit(0))).alias("depth"))
    else:
        raise ValueError("parents form a cycle")
    return now.select("id", F.coalesce("up", "id").alias("root"), "depth")


def roots_within(df: DataFrame, levels: int, id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """roots() for a known number of levels, as one plan without rounds."""
    ids = one_row_an_id(df, id_col, parent_col)
    out = ids.select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth"))
    step = ids.select(F.col("id").alias("root"), F.col("up").alias("next"))
    there = ids.select(F.col("id").alias("next"), F.lit(1).cast("long").alias("one"))
    step = step.join(there, "next").select("root", "next", "one")
    for _ in range(levels):
        out = out.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("one", F.lit(0))).alias("depth"))
    return out


def enriched(df: DataFrame, root_of: DataFrame, names: tuple[str, ...] = ("locus_tag", "name")) -> DataFrame:
    """df(id, attrs map), all its rows, with the named attributes, taken from its root where a row lacks them; of a root's several rows the first value counts."""
    top = df.groupBy(F.col("id").alias("root")).agg(*[F.min(A.first_of("attrs", n)).alias(f"root_{n}") for n in names])
    x = df.join(root_of, "id", "left").join(top, "root", "left")
    return x.select("id", "root", "depth", *[F.coalesce(A.first_of("attrs", n), F.col(f"root_{n}")).alias(n) for n in names])


def with_uid(df: DataFrame, group: str, order: list[str], tile: int = 1 << 20) -> DataFrame:
    """An id uid1, uid2, ... by group, then by a total order within it that begins with a number, without one task that holds all rows of either.

    Rows are numbered within tiles of their group (a contig), and each tile starts after the rows of those before it.
    """
    df = df.withColumn("__tile", F.floor(F.col(order[0]) / tile))
    inside = df.withColumn("__i", F.row_number().over(Window.partitionBy(group, "__tile").orderBy(*order)))
    sizes = df.groupBy(group, "__tile").count()  # a row a tile
    before = sizes.select(group, "__tile", F.coalesce(F.sum("count").over(Window.orderBy(group, "__tile").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return inside.join(before, [group, "__tile"]).withColumn("uid", F.concat(F.lit("uid"), (F.col("__i") + F.col("__before")).cast("string"))).drop("__i", "__before", "__tile")


def with_kind_counter(df: DataFrame, kind: str, order: list[str], tile: int = 1 << 20) -> DataFrame:
    """An id gene1, gene2, ..., cds1, ... of each kind in lower case, by a total order that begins with the contig and a number. Rows are numbered as by with_uid."""
    df = df.withColumn("__k", F.lower(kind)).withColumn("__tile", F.floor(F.col(order[1]) / tile))
    inside = df.withColumn("__i", F.row_number().over(Window.partitionBy("__k", order[0], "__tile").orderBy(*order)))
    sizes = df.groupBy("__k", order[0], "__tile").count()  # a row a tile and kind
    earlier = Window.partitionBy("__k").orderBy(order[0], "__tile").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__k", order[0], "__tile", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    return inside.join(before, ["__k", order[0], "__tile"]).withColumn("kind_id", F.concat("__k", (F.col("__i") + F.col("__before")).cast("string"))).drop("__k", "__i", "__before", "__tile")


def tagged_by_annotation(orfs: DataFrame, annotation: DataFrame, keys: list[str], tags: tuple[str, ...]) -> DataFrame:
    """orfs(keys, attrs map) renamed as by renamed_by_annotation, and with those of the named tags that the annotation(keys, id, attrs) has and they lack."""
    a = annotation.groupBy(*keys).agg(F.min_by("attrs", "id").alias("a"))  # of rows at one place the first by id
    x = orfs.join(a, keys, "left")
    name = F.coalesce(A.first_of("a", "gene_name", "name"), A.first_of("attrs", "name"))
    more = F.map_filter(F.col("a"), lambda k, v: k.isin(*tags) & (v != "") & ~F.map_contains_key(F.col("attrs"), k))
    rest = F.map_concat(F.map_filter("attrs", lambda k, v: k != "name"), F.coalesce(more, F.create_map().cast("map<string, string>")))
    return x.withColumn("attrs", F.when(name.isNull(), rest).otherwise(F.map_concat(rest, F.create_map(F.lit("name"), name)))).drop("a")


def plain_features(df: DataFrame) -> DataFrame:
    """Features that aren't coding sequences or what contains these."""
    return df.where(~F.lower("feature").isin("cds", "gene", "pseudogene", "exon"))


def reclassified(biotype: Column) -> Column:
    """Feature of a gene's biotype."""
    b = F.lower(biotype)
    return F.when(b == "protein_coding", "CDS").when(b.isin("rrna", "trna", "srna", "ncrna", "tmrna"), F.regexp_replace(b, "rna$", "RNA")).when(b.like("%pseudogene"), "pseudogene").otherwise("misc")


def filled_from_gene(cds: DataFrame, genes: DataFrame, keys: list[str], names: tuple[str, ...]) -> DataFrame:
    """cds with the named columns, taken from the gene at the same place where they are null or empty."""
    g = genes.select(*keys, *[F.col(n).alias(f"g_{n}") for n in names]).dropDuplicates(keys)
    return cds.join(g, keys, "left").select(*[c for c in cds.columns if c not in names], *[F.coalesce(F.nullif(F.col(n), F.lit("")), F.col(f"g_{n}")).alias(n) for n in names])


def renamed_by_annotation(orfs: DataFrame, annotation: DataFrame, keys: list[str]) -> DataFrame:
    """orfs(keys, name) with the annotation's gene_name, else its name, else their own; and whether it was found."""
    a = annotation.groupBy(*keys).agg(F.min("gene_name").alias("gene_name"), F.min("a_name").alias("a_name"), F.lit(True).alias("found"))
    return orfs.join(a, keys, "left").withColumn("name", F.coalesce(F.nullif("gene_name", F.lit("")), F.nullif("a_name", F.lit("")), "name")).withColumn("found", F.coalesce("found", F.lit(False))).drop("gene_name", "a_name")


def genes_of_gtf(rows: DataFrame) -> DataFrame:
    """From rows(gene_id, feature, chrom, start1, stop1, strand): one gene and its CDS and RNA each, CDS within the gene's span.

    A gene that is missing is made from its parts, drawn out by the stop codon; of rows that repeat the outermost counts.
    """
    kind = F.when(F.col("feature") == "gene", "gene").when(F.col("feature") == "CDS", "CDS").when(F.col("feature").like("%RNA"), "RNA")
    x = rows.withColumn("kind", kind).where("kind is not null").groupBy("gene_id").pivot("kind", ["gene", "CDS", "RNA"]).agg(F.min("chrom").alias("chrom"), F.min("start1").alias("start1"), F.max("stop1").alias("stop1"), F.min("strand").alias("strand"))
    chrom, strand = F.coalesce("gene_chrom", "CDS_chrom", "RNA_chrom"), F.coalesce("gene_strand", "CDS_strand", "RNA_strand")
    orphan = F.col("gene_start1").isNull() & F.col("CDS_start1").isNotNull()
    low, high = F.coalesce("gene_start1", "CDS_start1", "RNA_start1"), F.coalesce("gene_stop1", "CDS_stop1", "RNA_stop1")
    start = F.when(orphan & (strand == "-"), low - 3).otherwise(low)
    stop = F.when(orphan & (strand == "+"), high + 3).otherwise(high)
    parts = F.filter(F.array(F.lit("gene"), F.when(F.col("CDS_start1").isNotNull(), F.lit("CDS")), F.when(F.col("RNA_start1").isNotNull(), F.lit("RNA"))), lambda p: p.isNotNull())
    return x.select("gene_id", F.explode(parts).alias("feature"), chrom.alias("chrom"), start.alias("start1"), stop.alias("stop1"), strand.alias("strand"))


def with_parent(df: DataFrame, columns: list[str], id_col: str = "id", parent_col: str = "parent") -> DataFrame:
    """All rows of df with their direct parent's columns as parent_...; of a parent's several rows the least by columns counts."""
    up = df.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__up")).agg(F.min(F.struct(*columns)).alias("__p"))
    return df.join(up, F.col(parent_col) == F.col("__up"), "left").select(*df.columns, *[F.col(f"__p.{c}").alias(f"parent_{c}") for c in columns])


def annotated(df: DataFrame, attrs: str = "attrs", names: tuple[str, ...] = ("locus_tag", "name", "gene_name", "old_locus_tag")) -> DataFrame:
    """The rows of which one of the named attributes at least isn't empty."""
    return df.where(A.first_of(attrs, *names).isNotNull())
