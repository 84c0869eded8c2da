"""Connected components of a link table by alternating star contractions.

Every node's links are turned to its smallest neighbour, first among larger
neighbours, then among smaller ones, until each node points to the smallest
node of its component. All steps are grouped minima and equi-joins; a node
with very many links is pre-aggregated on the map side and its rows are split
by adaptive execution, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (both.where("b > a").join(least, "a")
            .select(F.col("m").alias("a"), "b").where("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    turned = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    least = turned.groupBy("hi").agg(F.min("lo").alias("m"))
    rest = turned.join(least, "hi").select(F.col("m").alias("a"), F.col("lo").alias("b"))
    own = least.select(F.col("m").alias("a"), F.col("hi").alias("b"))
    return rest.unionByName(own).where("a <> b").distinct()


def connected_components(work: Scratch, links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; label is the smallest node.

    Each round is written to the shared folder, and the round before it is
    dropped once it has been read."""
    table, before, turn = work.write(links.where("a <> b"), "links-0"), None, 0
    while True:
        turn += 1
        table = work.write(_small_star(_large_star(table)), f"links-{turn}")
        work.drop(f"links-{turn - 1}")
        now = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    return (table.groupBy("b").agg(F.min("a").alias("label"))
            .select(F.col("b").alias("node"), "label"))
