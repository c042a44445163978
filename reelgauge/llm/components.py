"""Connected components of a link table, by alternating star contractions.

Every round makes each node point its larger neighbours (large star), then its smaller ones (small star), at
the smallest node of its neighbourhood, until the links are stars. Rounds grow with the logarithm of the
longest path. All steps are aggregates, which fold before their shuffle, and joins that adaptive execution
can split when a node is a neighbour of very many. Every round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelgauge.session import ensure_checkpoint_dir


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """u, v -> node, component (the smallest node that can be reached); nodes without links are not listed."""
    ensure_checkpoint_dir(links.sparkSession)
    stars = (
        links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
        .checkpoint()
    )
    before = _state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = (
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        stars = small.checkpoint()
        after = _state(stars)
        if after == before:
            break
        before = after
    ends = stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return ends.unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
