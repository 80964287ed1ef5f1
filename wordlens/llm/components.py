"""Connected components of a link table by alternating large-star and small-star steps.

Every step is a group minimum and a join back; the table of a step is written to the
shared folder, so that a lost executor costs no earlier step and the plan stays short.
Nothing but two totals per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.session import materialize


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionByName(own).where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for each node with a link to another node; root is the smallest
    node of its component. Links may repeat and run either way; links of a node to
    itself and links with a null are left out. An empty table gives an empty one.

    Raises if the stars have not settled after ``max_rounds`` (they halve the depth
    each round, so 60 rounds are beyond any table).
    """
    edges = materialize(links.where(F.col(a) != F.col(b))
                        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(),
                        "components")
    seen = None
    for _ in range(max_rounds):
        edges = materialize(_small_star(_large_star(edges)), "components")
        total = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(total) == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(total)
    raise RuntimeError("the components did not settle")
