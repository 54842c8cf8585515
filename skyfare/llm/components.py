"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from skyfare.scratch import hold


def _toward(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger node to the smaller one, no loops."""
    return (
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its larger neighbours on the smallest node it knows."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node hangs its smaller neighbours and itself on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
        least.select("a", F.col("m").alias("b"))
    )


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): for every node of `edges` (a, b: bigint) the smallest node it is joined to.

    Alternates the two star steps until every node hangs directly on its root. A node with many
    links is only ever read through a grouped minimum and a join that can be split, and each
    round's links are written to the shared folder. Roots are listed with themselves.
    """
    now = hold(_toward(edges), "links")
    for _ in range(most_rounds):
        if now.rows == 0:
            break
        following = hold(_toward(_small_star(_toward(_large_star(now.df)))), "links")
        settled = following.rows == now.rows and (
            following.df.join(now.df, ["a", "b"], "left_anti").limit(1).count() == 0
        )
        now = following
        if settled:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    leaves = now.df.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return leaves.unionByName(now.df.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
