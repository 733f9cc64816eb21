"""Connected components by label propagation with pointer jumping, on DataFrames only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayer.sources.scratch import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for each node of ``links(a, b)``; ``root`` is the smallest node reachable.

    Every round a node takes the smallest root among its neighbours, and then the root of
    its root. Rounds are written to the scratch folder, so that a lost executor costs one
    round at most and plans stay short. No links give an empty table.
    """
    both = scratch.stage(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    roots = scratch.stage(
        both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("root")),
        "roots",
    )
    while True:
        seen = (
            both.join(roots.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("seen"))
        )
        taken = scratch.stage(
            roots.join(seen, "node").select("node", F.least("root", "seen").alias("root"), F.col("root").alias("was")),
            "taken",
        )
        if taken.where("root <> was").isEmpty():
            return taken.select("node", "root")
        # Only roots that have got a new root themselves are worth a jump; they are few.
        moved = taken.where("root <> node").select(F.col("node").alias("root"), F.col("root").alias("further"))
        moved = moved.join(taken.select("root").distinct(), "root", "left_semi")
        roots = scratch.stage(
            taken.join(moved, "root", "left").select("node", F.coalesce("further", "root").alias("root")), "roots"
        )
