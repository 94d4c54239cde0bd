"""Connected components of an edge table by large-star and small-star rounds.

Each round is two equi-joins and partial aggregations on narrow rows; its
result is written to the shared folder. A node with very many edges is a
join key only, never a group, and rounds grow with the logarithm of the
largest component's width.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.scratch import dropped, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of all nodes with an edge to another; label is the least node of the component.

    Self edges and edges with a null end are ignored; repeated edges count once.
    """
    cur = written(edges.where(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                  "edges")
    seen = None
    while True:
        sums = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND((1 << 31) - 1))).first())
        if sums == seen or sums[0] == 0:
            break
        seen = sums
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Written before they are joined: the join then splits the rows of a node with very many edges.
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "edges")
        lower = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(lower, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = written(small.unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "edges")
        for old in (cur, least, large, lower):
            dropped(old)
        cur = nxt
    return cur.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("label"))).distinct()
