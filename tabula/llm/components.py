"""Connected components of an edge table, by alternating large and small stars.

Each round hangs neighbours under smaller ones with two joins; the edges shrink to one star
per component. Rounds are written to the shared folder, which cuts the lineage. Nothing is
collected but the count and a checksum that tell when the edges stopped changing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabula.llm.common import saved


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    # a node's larger neighbours hang under its smallest one
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(low, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.max(F.xxhash64("v", "u"))).first())


def connected(edges: DataFrame, path: str) -> DataFrame:
    """(node, root) of every node with an edge; ``edges`` has (a, b); root is the smallest node of
    the component, which is its own row as well. ``path``: a new folder in shared storage."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = saved(now, f"{path}/0")
    mark, turn = _mark(now), 0
    while mark[0]:
        turn += 1
        now = saved(_small_star(_large_star(now)), f"{path}/{turn}")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
