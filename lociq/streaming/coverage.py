"""Coverage of alignments as they arrive, by Structured Streaming.

The state is what changes at each position where an alignment begins or ends, keyed by tile and position; a micro-batch writes the changed ones in a folder
of its own, which a repeated batch overwrites. Coverage is read from the latest of each by the same sums along a chromosome as in a batch.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from ..operators.intervals import running

#: Positions of a tile.
TILE = 1 << 16


def running_ends(reads: DataFrame, keys: Sequence[str], span: tuple[str, str], weight: str | None = None) -> DataFrame:
    """keys, tile, p, change: by how much the depth changes at p, of all alignments so far; in update mode the changed ones. Spans are closed; null ends count nowhere."""
    a, b = span
    w = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    ends = reads.where(F.col(b) >= F.col(a)).select(*keys, F.explode(F.array(F.struct(F.col(a).alias("p"), w.alias("w")), F.struct((F.col(b) + 1).alias("p"), (-w).alias("w")))).alias("e"))
    return ends.groupBy(*keys, F.floor(F.col("e.p") / TILE).alias("tile"), F.col("e.p").alias("p")).agg(F.sum("e.w").alias("change"))


def start(reads: DataFrame, keys: Sequence[str], span: tuple[str, str], path: str, checkpoint: str, weight: str | None = None, **trigger) -> StreamingQuery:
    """Keep the changes of a stream of alignments under path."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    out = running_ends(reads, keys, span, weight).writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (out.trigger(**trigger) if trigger else out).start()


def runs(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """keys, start0, stop0, depth so far; None before the first batch."""
    try:
        written = spark.read.option("basePath", path).parquet(path)
    except AnalysisException:
        return None
    latest = written.groupBy(*keys, "p").agg(F.max_by("change", "batch").alias("change")).where("change <> 0")
    depth = running(latest, keys, ["change"])
    return depth.where("change <> 0").select(*keys, F.col("p").alias("start0"), (F.col("next") - 1).alias("stop0"), F.col("change").alias("depth"))
