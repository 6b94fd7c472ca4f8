"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cdclake.llm.common import stage


def _checksum(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(mixed.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(mixed, 32))).first())


def _to_least(pairs: DataFrame) -> DataFrame:
    """``pairs (u, v)`` with ``m``, the least number among ``u`` and its partners.

    The null-safe key gives both join sides a shuffle of their own, so the
    skew join can split a number that has very many partners; with a plain key
    the aggregate's partitioning would be taken over and could not be split.
    """
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    return pairs.join(least, F.col("u").eqNullSafe(F.col("_u"))).drop("_u")


def connected_components(edges: DataFrame) -> DataFrame:
    """``(id, root)`` for every number that has an edge; the root is the component's least number.

    ``edges`` has two bigint columns. Alternating large-star and small-star
    steps move every edge towards the least number nearby; they end when the
    edges are stars, after a number of rounds that grows with the logarithm of
    the component size. Every round is joins and aggregations over the edge
    list (a number with very many edges is split by the skew join) and is
    written to the shared folder.
    """
    u, v = edges.columns[:2]
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where("u > v").distinct()
    now = stage(now, "edges")
    before = _checksum(now)
    while before[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        pointed = _to_least(large)
        small = pointed.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        now = stage(small, "edges")
        after = _checksum(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("id"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct()
    )
