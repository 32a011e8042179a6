"""The registered queries of this subpackage and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, exact_dedup, licenses, mixing, pii, quality, repair, sampling, secrets, simhash, toxicity, whitening
from .common import fold, table

RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer(name: str = RANKS) -> tuple[str, str]:
    """Path and pattern of a public rank file."""
    import public_tokenizers

    return public_tokenizers.path(name), public_tokenizers.PATTERN


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def joined(spans: str):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """Counts of the base spans by kind, their hash, and all spans."""
    kind = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kind, k))).cast("long").alias(f"n_{k}") for k in kinds]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(secrets.find(table(spark, sf_dir, "documents")), secrets.BASE)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(pii.find(table(spark, sf_dir, "documents")), pii.BASE)


def op4_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.scores(table(spark, sf_dir, "documents"))


def judged(scores: DataFrame, threshold: float) -> DataFrame:
    """A classifier's result with the fold that held a document out, and its decision."""
    return scores.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))), 0.5)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def token_digests(docs: DataFrame) -> DataFrame:
    path, pattern = tokenizer()
    out = bpe.round_trip(docs, path, pattern)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judged(quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"))), 0.3)


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sampling.shares(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_licenses": op1_licenses,
        "op2_secrets": op2_secrets,
        "op3_pii": op3_pii,
        "op4_context_mixing": op4_context_mixing,
        "op5_toxicity": op5_toxicity,
        "op6_exact_dedup": op6_exact_dedup,
        "op7_decontamination": op7_decontamination,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_simhash": op9_simhash,
        "op10_quality": op10_quality,
        "op11_mixing": op11_mixing,
        "op12_whitening": op12_whitening,
        "op13_repair": op13_repair,
    }


def oracle_sql() -> dict[str, str]:
    normal = r"regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g')"
    return {
        "op6_exact_dedup": f"""
            WITH d AS (SELECT doc_id, {normal} AS t FROM documents),
            g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON d.t = g.t""",
        "op11_mixing": r"""
            WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
            s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
            b AS (SELECT *, 3.0 * source_size / w AS b, sum(source_size) OVER () AS total, sum(w) OVER () AS whole FROM s),
            c AS (SELECT *, row_number() OVER (ORDER BY b, source NULLS LAST) AS k, coalesce(sum(3 * source_size) OVER before, 0) AS full_size, coalesce(sum(w) OVER before, 0) AS full_w FROM b
                WINDOW before AS (ORDER BY b, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
            l AS (SELECT arg_min(CAST(total - full_size AS DOUBLE) / CAST(whole - full_w AS DOUBLE), k) AS level FROM c WHERE CAST(total - full_size AS DOUBLE) / CAST(whole - full_w AS DOUBLE) <= b),
            t AS (SELECT source, source_size, CASE WHEN w * level > 3 * source_size THEN CAST(3 * source_size AS DOUBLE) ELSE w * level END AS target,
                CAST(CAST('0x' || substr(md5('42:' || coalesce('=' || source, '')), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0 AS u FROM s, l),
            r AS (SELECT d.doc_id, d.size, t.source_size, t.target, u, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
                row_number() OVER (PARTITION BY d.source ORDER BY d.size DESC, md5('42:' || coalesce(CAST(d.doc_id AS VARCHAR), ''))) AS k FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
            SELECT doc_id, size, source_size, target, size * CAST(floor(k * rate + u) - floor((k - 1) * rate + u) AS BIGINT) AS taken FROM r""",
    }
