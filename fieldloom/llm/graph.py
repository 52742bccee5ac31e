"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import removed, written


def _digest(df: DataFrame) -> tuple:
    row = df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """node and root (the smallest node reachable) of every node that has an edge to another.

    edges has two columns of one orderable type; loops and rows with a null are ignored, repeated edges count once.
    Each half-step is an aggregate and a join on its result, so that a node with very many edges is
    pre-aggregated and its rows can be split; each round is written to the shared folder and the one before it
    deleted.  No edges: an empty result.
    """
    a, b = (F.col(c) for c in edges.columns)
    spark = edges.sparkSession
    now, path = written(edges.filter(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "edges")
    seen = _digest(now)
    for _ in range(rounds):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        small = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).filter("hi != lo").union(low.select("hi", F.col("m"))).distinct()
        after, new = written(small, "edges")
        digest = _digest(after)
        removed(spark, path)
        now, path = after, new
        if digest == seen:
            break
        seen = digest
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select("lo", "lo").distinct())
