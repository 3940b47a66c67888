"""Connected components of an edge table, as Spark jobs.

Large-star and small-star steps in turn: every node hands its greater neighbours to the least node
it knows, until all edges point at the least node of their component. A node's edges shrink to one,
so a hub does not gather more than it had, and each round is written to the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    forward = edges.select("a", "b")  # a > b
    around = forward.union(edges.select("b", "a")).toDF("a", "b") if large else forward
    least = around.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    joined = around.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least.select("a", "least"))
    return moved.where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1] or 0


def components(pairs: DataFrame) -> DataFrame:
    """``node`` and the least ``component`` node it is linked with, for every node of ``pairs``.

    ``pairs`` has two long columns. Loops and repeated pairs do not matter; rows with a null in
    either column are no links. No pairs give no rows. Nodes without a link are not in the result.
    """
    x, y = pairs.columns
    edges = checkpointed(
        pairs.where(F.col(x) != F.col(y)).select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b")).distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        edges = checkpointed(_starred(_starred(edges, large=True), large=False))
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.toDF("node", "component").union(roots)
