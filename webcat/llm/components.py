"""Connected components of an edge table by repeated contraction; DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webcat.llm.common import saved


def _priority(node: str, number: int) -> Column:
    """The first round prefers small ids, which folds stars onto their hub; later ones a random order."""
    return F.col(node) if number == 0 else F.xxhash64(F.col(node), F.lit(number))


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long ids -> (node, root): nodes of one component share the root, one of its members.

    Each round every node points to the neighbour (or itself) that comes first in the round's order, and the
    graph is contracted along the pointers. In a random order the number of nodes falls by a constant factor
    per round, so the rounds are logarithmic; each works on what the last one left. A hub never sits in one
    task: its neighbours are reduced map-side, and both sides of every join are saved tables that a skewed
    join may split. Loops, repeated and null-ended edges are allowed; without edges the result is empty.
    """
    current = saved(edges.select("a", "b").filter("a <> b"), "edges")
    steps: list[DataFrame] = []
    while current.take(1):
        number = len(steps)
        both = current.union(current.select("b", "a"))
        best = both.groupBy("a").agg(F.min(F.struct(_priority("b", number).alias("p"), F.col("b").alias("id"))).alias("best"))
        own = F.struct(_priority("a", number).alias("p"), F.col("a").alias("id"))
        step = saved(best.select(F.col("a").alias("node"), F.least("best", own)["id"].alias("to")), "pointers")
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = current.join(left, "a").join(right, "b").filter("ta <> tb")
        current = saved(
            moved.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges"
        )
    if not steps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = steps[0]
    for step in steps[1:]:
        nxt = step.select(F.col("node").alias("to"), F.col("to").alias("further"))
        labels = labels.join(nxt, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
    return labels.select("node", F.col("to").alias("root"))
