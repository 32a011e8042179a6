"""The corpus pipeline: five stages, each a corpus operator over all that the one before it kept.

Null texts count as empty, which equal each other, so one of them stays; of rows that repeat one stays; rows of a repeated id with other texts stay. A null id comes after all
others. Very long texts are worked on whole. Other columns of documents, of any name, pass through all stages but the last. Empty tables give an empty result.

Near-dedup links texts as `op9_simhash` does, by SimHash within four bits, and besides those whose five-word shingles have a Jaccard similarity of 0.8
(`lociq.llm.near`), most of which lie further apart. Of what either links one stays.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lociq.llm import decontam, exact_dedup, near, queries, simhash, toxicity
from lociq.llm.common import stored, table

#: SQL can't express a network's scores, edit matching or the tokenizer.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near.one_of_each(docs, others=simhash.links)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return queries.token_digests(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("exact dedup", without_copies),
    ("near-dedup", without_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = docs if i == len(STAGES) - 1 else stored(docs)
    return docs
