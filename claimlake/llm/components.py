"""Connected components of an edge list, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import checkpointed, in_few_tasks


def _rank(column: str) -> Column:
    return F.struct(F.xxhash64(column).alias("key"), F.col(column).alias("at"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b); nodes of a component share their root.

    In each round a node is merged into the first node next to it, in the order of
    a hash, and edges are kept between what is left. Only nodes that are first
    beside another stay: a star is one node after two rounds, and a chain shrinks by
    a constant factor a round however it is laid out. Minima and distinct edges
    combine in the map tasks; joins on a hub are split by AQE. Loops are dropped,
    repeated edges count once, no edges give no rows.
    """
    left = edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left, merges = checkpointed(left), []
    rows = most = left.count()
    while rows:
        both = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_rank("b")).alias("best"))
        best = best.select(F.col("a").alias("node"), F.least("best", _rank("a"))["at"].alias("root"))
        merge = checkpointed(in_few_tasks(best, 2 * rows))
        merges.append(merge)
        to_a, to_b = (merge.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")) for c in "ab")
        moved = in_few_tasks(left.join(to_a.hint("merge"), "a"), rows)
        moved = in_few_tasks(moved.join(to_b.hint("merge"), "b"), rows).where("root_a <> root_b")
        moved = moved.select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
        left = checkpointed(in_few_tasks(moved.distinct(), rows))
        rows = left.count()
    if not merges:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = merges[0]
    for merge in merges[1:]:
        later = merge.select(F.col("node").alias("root"), F.col("root").alias("later"))
        found = in_few_tasks(found.join(later.hint("merge"), "root", "left"), 2 * most)
        found = found.select("node", F.coalesce("later", "root").alias("root"))
    return checkpointed(found)
