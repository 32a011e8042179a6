"""Connected components of a link table, with tables in the shared folder between rounds."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node, root (the smallest node reachable) for every node in links(u long, v long).

    Large-star and small-star rounds: each node's larger neighbours, then its smaller ones, move to its smallest
    neighbour, until nothing changes. Minimums are pre-aggregated, so a hub isn't gathered. A link from a node to
    itself only lists it.
    """
    nodes = stored(links.select(F.explode(F.array("u", "v")).alias("node")).distinct())
    now = stored(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(most_rounds):
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            break
        before = state
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = stored(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(moved.union(least.select("u", "m")).distinct())
    else:
        raise RuntimeError("components haven't settled")
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
