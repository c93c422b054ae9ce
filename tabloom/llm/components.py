"""Connected components by alternating large and small stars, on DataFrames alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabloom.llm.common import stored


def _mark(e: DataFrame):
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head())


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Nodes are of any ordered type. Each round links neighbours to the smallest
    node seen (minima combine before the shuffle), is stored in the shared
    folder, and ends when nothing changes. Null ends and loops are ignored.
    """
    e = stored(edges.filter(F.col("a") != F.col("b"))
               .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _mark(e)
    while mark[0]:
        both = e.select("u", "v").union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(moved.union(least.select("u", "m")).distinct(), "edges")
        now = _mark(e)
        if now == mark:
            break
        mark = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
