"""Connected components by min labels with pointer jumping, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import cut, workspace


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (smallest node reachable) for each node of an edge table.

    Each round a node takes the least label among its own and its neighbours' (a partial, then a
    final aggregate: a hot node needs no gathering), then the label of that label until labels
    stand still.  The label of a root is itself, so labels only shrink and end at the minimum of
    the component.  Null ends are ignored, self-loops keep their node.  The tables of the rounds go
    at the end.
    """
    e = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    with workspace(edges.sparkSession) as own:
        both = own(e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
        labels = own(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).select(F.col("a").alias("node"), "label"))
        moved = True
        while moved:
            around = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
            hooked = labels.join(around.select(F.col("a").alias("node"), "near"), "node").select("node", "label", F.least("label", "near").alias("least"))
            # a root hooks to the least label that any of its members has found
            roots = hooked.groupBy("label").agg(F.min("least").alias("root"))
            step = hooked.join(roots, "label").select("node", F.col("label").alias("old"), F.least("least", "root").alias("mid"))
            up = roots.select(F.col("label").alias("mid"), F.col("root").alias("upper"))
            new = own(step.join(up, "mid", "left").select("node", "old", F.least("mid", F.coalesce("upper", "mid")).alias("label")))
            moved = new.where("label < old").limit(1).count() > 0
            labels = new.select("node", "label")
        return cut(labels.select("node", F.col("label").alias("component")))
