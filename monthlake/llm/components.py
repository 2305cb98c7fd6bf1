"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthlake.llm.common import write_shared


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; ``root`` is one node per component.

    Each round maps every node to its neighbour (or itself) with the smallest random rank, maps
    that once more, and relabels the edges; edges inside one label vanish. The ranks are drawn
    anew each round, so chains as well as stars shrink by a constant factor. Minima are
    aggregated partially, so a hub sends one row per task. Every round is written to the shared
    folder. Null nodes are dropped; self links keep their node; no edges give no rows."""
    edges = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull())
    labels = write_shared(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                               .withColumn("label", F.col("node")), "cc-labels")
    edges = write_shared(_between(edges), "cc-edges")
    turn = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.lit(turn), F.col(c)).alias("r"), F.col(c).alias("n"))  # noqa: B023, E731
        up = both.groupBy("a").agg(F.min(rank("b")).alias("m")).select(
            F.col("a").alias("n"), F.least(F.col("m"), rank("a"))["n"].alias("p"))
        up = write_shared(up, "cc-up")
        jump = up.select(F.col("n").alias("p"), F.col("p").alias("q"))
        up = write_shared(up.join(jump, "p").select("n", F.col("q").alias("p")), "cc-up2")
        moved = labels.join(up, F.col("label") == F.col("n"), "left")
        labels = write_shared(moved.select("node", F.coalesce("p", "label").alias("label")), "cc-labels")
        ends = edges.join(up, F.col("a") == F.col("n")).select(F.col("p").alias("a"), "b")
        ends = ends.join(up, F.col("b") == F.col("n")).select("a", F.col("p").alias("b"))
        edges = write_shared(_between(ends), "cc-edges")
        turn += 1
    return labels.select("node", F.col("label").alias("root"))


def _between(edges: DataFrame) -> DataFrame:
    return edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
