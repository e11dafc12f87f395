"""Connected components of a graph whose edges no single machine can hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def connected_components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of all nodes of links (u long, v long); root is the least node reachable.

    Alternates the large-star and small-star steps of Kiveris et al. (2014).  Each round halves
    the depth of the trees at least, and ends as a table in the shared folder.  Minima are
    combined before they are shuffled, so that a node with very many neighbours is no hot spot.
    Self-links and repeated links are allowed; nulls are dropped.
    """
    edges = materialise(
        links.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b"))
        .distinct()
    )
    before = _signature(edges)
    for _ in range(rounds):
        if before[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
            .select("e.*")
            .where("a <> b")
            .distinct()
        )
        edges = materialise(small)
        after = _signature(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftrightunsigned(h, 34))).first())
