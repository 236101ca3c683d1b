"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialise

MAX_ROUNDS = 60


def _stars(links: DataFrame) -> DataFrame:
    """Every link from both its ends, with the smallest node among the end and its neighbours.

    The smallest nodes are written first: a join of two plain scans is one whose hubs adaptive execution
    can split.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.min("a")).alias("least"))
    return both.join(materialise(least, "least"), "a")


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are linked to its smallest neighbour."""
    return (
        _stars(links).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    ).where("a != b")


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    down = materialise(down, "down")
    least = materialise(down.groupBy("a").agg(F.min("b").alias("least")), "least")
    smaller = down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select("a", F.col("least").alias("b"))
    return smaller.where("a != b").unionByName(own).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach, the root itself included.

    ``links`` has the columns ``a`` and ``b`` of one orderable type. Each round is written to the
    shared folder, which cuts the lineage; rounds end when the set of links, compared by count and
    sum of hashes, no longer changes. Their number grows with the logarithm of the longest path.
    """
    current = materialise(links.where("a != b").distinct(), "links")
    last = None
    for _ in range(MAX_ROUNDS):
        current = materialise(_small_star(_large_star(current)), "links")
        state = current.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"links still change after {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
