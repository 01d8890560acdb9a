"""Connected components of an edge table, by contraction.

Each round every node takes its least neighbour as parent, and the edges are
redrawn between parents; edges inside a parent vanish. Hubs send one row per task
(partial minima), and their joins are plain equi-joins that adaptive execution
splits. After the first round nodes are ordered by a hash that changes with the
round, so that a long chain shrinks by a constant factor as well.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retail_lake.llm.common import stored


def _priority(node: str, turn: int) -> Column:
    return F.col(node) if turn == 0 else F.xxhash64(F.lit(turn), F.col(node))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for each node of the edges ``(a, b)`` (bigint); the
    component is the smallest node reachable. Loops, repeats and both directions of
    an edge are fine; edges with a NULL end are ignored. No edges give no rows."""
    edges = edges.select("a", "b").where("a != b")
    parents: list[DataFrame] = []
    while True:
        turn = len(parents)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = F.min(F.struct(_priority("b", turn).alias("p"), F.col("b")))
        own = F.struct(_priority("node", turn).alias("p"), F.col("node").alias("b"))
        parent = stored(
            both.groupBy(F.col("a").alias("node"))
            .agg(best.alias("best"))
            .select("node", F.least("best", own).getField("b").alias("parent")),
            "components",
        )
        parents.append(parent)
        to = lambda end: parent.select(F.col("node").alias(end), F.col("parent").alias(f"{end}_"))
        low, high = F.least("a_", "b_"), F.greatest("a_", "b_")
        edges = stored(
            edges.join(to("a"), "a").join(to("b"), "b").where("a_ != b_").select(low.alias("a"), high.alias("b")).distinct(),
            "components",
        )
        if edges.isEmpty():
            break
    label = parents.pop()
    while parents:
        further = label.select(F.col("node").alias("parent"), F.col("parent").alias("root"))
        label = parents.pop().join(further, "parent", "left").select("node", F.coalesce("root", "parent").alias("parent"))
    label = stored(label, "components")
    least = label.groupBy("parent").agg(F.min("node").alias("component"))
    return label.join(least, "parent").select("node", "component")
