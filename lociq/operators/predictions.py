"""Predicted reading frames: collapsing calls, ranks, unions, and the overview of all sources."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranking

LOCUS = ["chrom", "start1", "stop1", "strand"]


def evidence(tool: str, condition: Column, replicate: Column) -> Column:
    """tool-condition-replicate."""
    return F.concat_ws("-", F.lit(tool), condition, replicate.cast("string"))


def prefixed(evidence_list: Column, tool: str) -> Column:
    """A blank-separated list with the tool before each entry that lacks it, sorted, each once."""
    parts = F.filter(F.split(evidence_list, " "), lambda x: x != "")
    return F.array_join(F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.when(x.startswith(tool + "-"), x).otherwise(F.concat(F.lit(tool + "-"), x))))), " ")


def collapsed(calls: DataFrame, order: str) -> DataFrame:
    """One row a locus: the best score, the distinct evidence, and the start distance of its last call by order."""
    best = F.max("pred").alias("pred")
    seen = F.array_join(F.array_sort(F.collect_set("evidence")), " ").alias("evidence")
    return calls.groupBy(*LOCUS).agg(best, seen, F.max_by("dist", order).alias("dist"), F.count(F.lit(1)).alias("calls"))


def collapsed_by_id(calls: DataFrame, order: str, keep: list[str]) -> DataFrame:
    """One row an id of calls(id, evidence, orf_type, prob): distinct evidence and types, the largest probability, and the first row's other columns by order."""
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), " ").alias(c)
    out = calls.groupBy("id").agg(listed("evidence"), listed("orf_type"), F.max("prob").alias("prob"), F.min_by(F.struct(*keep), order).alias("first"))
    return out.select("id", "evidence", "orf_type", "prob", *[F.col(f"first.{c}").alias(c) for c in keep])


def ranked(loci: DataFrame) -> DataFrame:
    """pred_rank by falling score (ties by locus), and novel_rank among the loci with dist -1, else null. No task holds all rows, or all of a score."""
    novel = F.col("dist") == -1
    out = ranking.ranked(loci, [], [F.desc_nulls_last("pred"), *map(F.col, LOCUS)], "pred_rank", {"novel_rank": novel})
    return out.withColumn("novel_rank", F.when(novel, F.col("novel_rank")))


def united(parts: list[DataFrame]) -> DataFrame:
    """All rows of all tables, by column name; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def overview(sources: dict[str, DataFrame], values: list[str]) -> DataFrame:
    """Full outer join of the sources on the locus: each named value from the first source, in the order given, that has it.

    found lists the sources that hold the locus. A source has at most one row a locus.
    """
    out = None
    for name, df in sources.items():
        have = [v for v in values if v in df.columns]
        df = df.select(*LOCUS, *[F.col(v).alias(f"{name}__{v}") for v in have], F.lit(True).alias(f"{name}__in"))
        out = df if out is None else out.join(df, LOCUS, "full")
    pick = [F.coalesce(*[F.col(f"{n}__{v}") for n, d in sources.items() if v in d.columns]).alias(v) for v in values]
    found = F.array_join(F.filter(F.array(*[F.when(F.col(f"{n}__in"), F.lit(n)) for n in sources]), lambda x: x.isNotNull()), ",")
    return out.select(*LOCUS, *pick, found.alias("found"))


def by_contrast(results: DataFrame, contrasts: list[str], metrics: list[str], order: str) -> DataFrame:
    """One row a locus, a column for each contrast and metric; of rows that repeat the first by order counts."""
    one = results.groupBy(*LOCUS, "contrast").agg(*[F.min_by(m, order).alias(m) for m in metrics])
    wide = one.groupBy(*LOCUS).pivot("contrast", contrasts).agg(*[F.first(m).alias(m) for m in metrics])
    return wide if len(metrics) > 1 else wide.select(*LOCUS, *[F.col(f"`{c}`").alias(f"{c}_{metrics[0]}") for c in contrasts])


def sheets(df: DataFrame, feature: str, names: dict[str, str]) -> DataFrame:
    """df with the sheet that each row belongs to; unknown features go to misc."""
    dim = df.sparkSession.createDataFrame(list(names.items()), "key string, sheet string")
    return df.withColumn("key", F.lower(feature)).join(F.broadcast(dim), "key", "left").withColumn("sheet", F.coalesce("sheet", F.lit("misc"))).drop("key")
