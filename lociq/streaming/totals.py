"""Totals and read-length counts of alignments as they arrive, by Structured Streaming.

Both are counts by key, so each micro-batch adds to the state and results equal those of a batch over all files.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.counting import mapped


def running_totals(reads: DataFrame) -> DataFrame:
    """library, chrom, n, sum_len of a stream of alignments; to be written in update or complete mode."""
    return reads.where(mapped()).groupBy("library", "chrom").agg(F.count(F.lit(1)).alias("n"), F.sum("read_length").alias("sum_len"))


def running_lengths(reads: DataFrame) -> DataFrame:
    return reads.groupBy("library", "chrom", "read_length").agg(F.count(F.lit(1)).alias("cnt"))
