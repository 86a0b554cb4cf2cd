"""Connected components of links, as joins and groupings only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillrank.storage import Scratch


def _both_ways(links: DataFrame) -> DataFrame:
    return links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is a name, one of its nodes.

    Each round points every node to the neighbour, or itself, that comes first in a random but
    fixed order, and contracts the links along these pointers. In a random order a fixed share of
    the nodes goes per round, also on long chains, so rounds grow with the logarithm. Pointers only
    lead to nodes earlier in the order, so following them round by round ends at one node per
    component. Null ends are ignored; repeated links count once; no links give no rows.
    """
    rank = lambda name: F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("node"))
    left = scratch.stored(links.select("a", "b").where("a <> b").distinct())
    rounds = []
    while not left.isEmpty():
        first = _both_ways(left).groupBy("a").agg(F.min(rank("b")).alias("near"))
        pointers = scratch.stored(
            first.select(F.col("a").alias("node"), F.least(rank("a"), F.col("near")).getField("node").alias("root"))
        )
        rounds.append(pointers)
        at_a = pointers.toDF("a", "a_root")
        at_b = pointers.toDF("b", "b_root")
        left = scratch.stored(
            left.join(at_a, "a").join(at_b, "b").where("a_root <> b_root")
            .select(F.col("a_root").alias("a"), F.col("b_root").alias("b")).distinct()
        )
    if not rounds:
        return left.toDF("node", "component")
    found = rounds[-1]
    for pointers in reversed(rounds[:-1]):
        later = found.toDF("root", "final")
        found = pointers.join(later, "root", "left").select("node", F.coalesce("final", "root").alias("root"))
    return scratch.stored(found.toDF("node", "component"))
