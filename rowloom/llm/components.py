"""Connected components of large graphs by local contraction.

Each round every node takes the least label in its neighbourhood, in an order
drawn anew, and edges are rewritten to labels; edges within a label vanish. The
number of labels shrinks by a constant factor a round, whatever the diameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every end of the edges (a, b); ``root`` is a node of the component.

    Edges may be repeated or loops; no edges give an empty result.
    """
    now = stored(edges.where("a <> b").select("a", "b"))
    maps, step = [], 0
    while not now.isEmpty():
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(c, step=step):
            return F.struct(F.xxhash64(c, F.lit(step)), c)

        least = both.groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        own = F.when(rank(F.col("a")) < F.col("m"), F.col("a")).otherwise(F.col("m").getField("b"))
        label = stored(least.select(F.col("a").alias("node"), own.alias("label")))
        maps.append(label)
        ends = now.join(label.select(F.col("node").alias("a"), F.col("label").alias("x")), "a")
        ends = ends.join(label.select(F.col("node").alias("b"), F.col("label").alias("y")), "b")
        now = stored(
            ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        )
        step += 1
    if not maps:
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = maps[-1].select("node", F.col("label").alias("root"))
    for label in reversed(maps[:-1]):
        later = found.select(F.col("node").alias("label"), "root")
        found = label.join(later, "label", "left").select("node", F.coalesce("root", "label").alias("root"))
    return found
