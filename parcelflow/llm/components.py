"""Connected components of a graph in tables: alternating large and small stars.

Every round is two joins of the edges with the least neighbour of each node. Least neighbours
are combined before the shuffle, and a node with very many edges is a hot join key that Spark
splits; no task holds the edges of one node. Nothing but counts comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelflow.llm.storage import write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges  # every edge already points from its larger end
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))
        )
    ends = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return ends.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges`` (columns ``u``, ``v``, of one type);
    the root is the least node of the component. Loops and repeated edges don't matter; edges
    with a null end are left out. No edges: no rows."""
    ends = edges.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    ends = ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = write_table(ends.where(F.col("u") != F.col("v")).distinct())
    mark = F.struct(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
    before = now.agg(mark).first()[0]
    while before[0]:
        now = write_table(_star(_star(now, True), False))
        after = now.agg(mark).first()[0]
        if after == before:
            break
        before = after
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
