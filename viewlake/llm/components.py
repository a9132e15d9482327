"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from viewlake.llm.scratch import cut

#: Edges for a task. Up to so many take each step in one task, without a shuffle.
TASK_EDGES = 50_000


def _dealt(pairs: DataFrame, rows: int) -> DataFrame:
    """The pairs in as many tasks as their number asks for."""
    return pairs.coalesce(1 + rows // TASK_EDGES)


def _with_least(pairs: DataFrame, rows: int) -> DataFrame:
    """(a, b, low): the pairs with the least b of each a."""
    if rows < TASK_EDGES:
        return pairs.withColumn("low", F.min("b").over(Window.partitionBy("a")))
    return pairs.join(pairs.groupBy("a").agg(F.min("b").alias("low")), "a")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the least node.

    Large-star and small-star steps by turns: each joins nodes to the least node
    among their neighbours, until nothing changes. Beyond one task's edges a node's
    neighbours are never gathered: their least one is an aggregate, which joins back.
    """
    pairs = cut(edges.where("a <> b").select("a", "b").distinct())
    rows, state = pairs.count(), None
    while True:
        # Both directions of a pair come from one row, as a union would need a shuffle.
        turned = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = _dealt(pairs, rows).select(F.explode(turned).alias("e")).select("e.*")
        large = _with_least(both, rows).where("b > a").select(F.col("b").alias("a"), F.least("a", "low").alias("b")).distinct()
        joined = F.array(F.struct(F.col("a"), F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))
        small = _with_least(large, rows).select(F.explode(joined).alias("e")).select("e.*").where("a <> b").distinct()
        pairs = cut(small)
        now = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a") % 1_000_003)).first()
        if now == state:
            break
        rows, state = now[0], now
    nodes = F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("root")), F.struct(F.col("b").alias("node"), F.col("b").alias("root")))
    # Each node comes once, so its rows are dealt out evenly, as joins by the node need them.
    return _dealt(pairs, rows).select(F.explode(nodes).alias("e")).select("e.*").distinct().repartition("node")
