"""Connected components of a graph that is an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeguard.session import written


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): one row per node, ``root`` the least node of its component.

    In each round every node joins the neighbour that comes first in an order
    drawn anew for the round, if that comes before itself; then the graph is
    contracted.  A constant share of the nodes goes in each round, also in
    chains and stars.  Minima are combined before they are shuffled, so hubs
    are no burden.  The rounds are tables in the shared folder.
    """
    graph = written(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges"
    )
    at = written(graph.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")), "roots")
    turn = 0
    while not graph.isEmpty():
        place = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("place"), F.col(c).alias("to"))
        both = graph.union(graph.select("b", "a"))
        hook = (
            both.groupBy(F.col("a").alias("from"))
            .agg(F.min(place("b")).alias("best"))
            .withColumn("to", F.least(place("from"), "best")["to"])
            .select("from", "to")
        )
        hook = written(hook, "hooks")
        at = written(
            at.join(hook, at["root"] == hook["from"], "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        )
        one, two = hook.select(F.col("from").alias("a"), F.col("to").alias("a_to")), hook.select(
            F.col("from").alias("b"), F.col("to").alias("b_to")
        )
        moved = graph.join(one, "a").join(two, "b")
        graph = written(
            moved.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
            .filter("a < b")
            .distinct(),
            "edges",
        )
        turn += 1
    least = at.groupBy("root").agg(F.min("node").alias("least"))
    return at.join(least, "root").select("node", F.col("least").alias("root"))
