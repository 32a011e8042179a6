"""Nucleotide sequences as columns. Positions are 0-based."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Genetic code 11, amino acids of the codons in the order TTT, TTC, TTA, TTG, TCT, ... GGG.
BASES = "TCAG"
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def complement(seq: Column) -> Column:
    return F.translate(seq, "ACGTacgt", "TGCAtgca")


def reverse_complement(seq: Column) -> Column:
    return F.reverse(complement(seq))


def oriented(seq: Column, start0: Column, stop0: Column, strand: Column) -> Column:
    """The closed stretch of the contig as it's read on its strand."""
    part = F.substring(seq, (start0 + 1).cast("int"), (stop0 - start0 + 1).cast("int"))
    return F.when(strand == "+", part).otherwise(reverse_complement(part))


def upstream(seq: Column, start0: Column, stop0: Column, strand: Column, n: int = 15) -> Column:
    """The n bases before the stretch on its strand; empty where the contig doesn't have them all before its start."""
    fwd = F.when(start0 >= n, F.substring(seq, (start0 - n + 1).cast("int"), F.lit(n))).otherwise("")
    return F.when(strand == "+", fwd).otherwise(reverse_complement(F.substring(seq, (stop0 + 2).cast("int"), F.lit(n))))


def of_features(features: DataFrame, contigs: DataFrame, tile: int = 1 << 16) -> DataFrame:
    """features(id, chrom, start0, stop0, strand) with seq: the closed stretch of contigs(chrom, seq) as it's read on its strand; empty where the contig isn't there.

    Contigs are cut into tiles and features into the parts that lie in them, so the join is by contig and tile and no row holds a contig beside a feature.
    """
    raw = contigs.select("chrom", F.encode("seq", "UTF-8").alias("raw"))  # ASCII letters: cut by bytes
    at = F.sequence(F.lit(0).cast("long"), F.greatest(F.length("raw").cast("long") - 1, F.lit(0)), F.lit(tile).cast("long"))
    tiles = raw.select("chrom", F.explode(F.transform(at, lambda a: F.struct((a / tile).cast("long").alias("tile"), F.substring(F.col("raw"), (a + 1).cast("int"), F.lit(tile)).alias("bases")))).alias("t")).select("chrom", "t.tile", "t.bases")
    parts = features.select("id", "chrom", "start0", "stop0", F.explode(F.sequence(F.floor(F.col("start0") / tile), F.floor(F.col("stop0") / tile))).alias("tile"))
    first, last = F.greatest(F.col("start0") - F.col("tile") * tile, F.lit(0)), F.least(F.col("stop0") - F.col("tile") * tile, F.lit(tile - 1))
    cut = F.decode(F.substring("bases", (first + 1).cast("int"), (last - first + 1).cast("int")), "UTF-8")
    whole = parts.join(tiles, ["chrom", "tile"]).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("tile", cut.alias("cut")))).alias("parts"))
    seq = F.coalesce(F.array_join(F.col("parts.cut"), ""), F.lit(""))
    out = features.join(whole, "id", "left").withColumn("seq", seq).drop("parts")
    return out.withColumn("seq", F.when(F.col("strand") == "+", F.col("seq")).otherwise(reverse_complement(F.col("seq"))))


def codon_index(codon: Column) -> Column:
    """Place of a codon in AMINO_ACIDS from 1; 0 if a letter isn't a base."""
    at = [F.instr(F.lit(BASES), F.substring(codon, i, 1)) for i in (1, 2, 3)]
    known = (at[0] > 0) & (at[1] > 0) & (at[2] > 0) & (F.length(codon) == 3)
    return F.when(known, (at[0] - 1) * 16 + (at[1] - 1) * 4 + at[2]).otherwise(0)


def translated(seq: Column) -> Column:
    """Amino acids to the first stop codon; empty where the length isn't a multiple of three; X for unknown codons."""
    codons = F.regexp_extract_all(seq, F.lit("(?s)..."), F.lit(0))
    letter = lambda c: F.when(codon_index(c) > 0, F.substring(F.lit(AMINO_ACIDS), codon_index(c), F.lit(1))).otherwise("X")
    whole = F.array_join(F.transform(codons, letter), "")
    return F.when(F.length(seq) % 3 == 0, F.substring_index(whole, "*", 1)).otherwise("")
