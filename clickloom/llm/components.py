"""Connected components by contraction.

In every round each node goes over to its neighbour of least priority, a hash,
if that is less than its own.  Links are then those of the nodes gone over to;
links inside one node and repeated ones are dropped.  Priorities are drawn anew
every second round, as good as random, so at most about half of the nodes are
left by then, whatever the shape of the links; the round between, with the same
ones, brings all leaves of a star to the least of them, where new ones would
halve their number.  Nodes with very many links, counted in the same pass, are
split where they are joined.  The rounds' moves are followed once, at the end,
from the last and smallest round to the first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.lookups import HOT_SHARE, salted_join
from .common import pin

#: A node with fewer links than this is not split, however few there are in all.
HOT_LINKS = 1000


def _moved(df: DataFrame, column: str, to: DataFrame, hot: list, spread: str) -> DataFrame:
    """``df`` with ``column`` replaced by what (old, new) says; others stay."""
    to = to.select(F.col("old").alias(column), F.col("new").alias("_new"))
    joined = salted_join(df, to, column, "left", [spread], hot=hot) if hot else df.join(to, column, "left")
    return joined.withColumn(column, F.coalesce("_new", column)).drop("_new")


def contract(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the (a, b) edges: nodes have one root if and only if edges connect them.

    Edges may be repeated, lead both ways, or from a node to itself; a null is a
    node that nothing connects.  Every round is written to the shared folder; a
    lost executor costs a re-read.
    """
    edges = pin(edges.select("a", "b").distinct())
    left, rounds = edges.count(), []
    while left:
        salt = len(rounds) // 2 + 1

        def priority(name, salt=salt):
            return F.xxhash64(F.lit(salt), F.col(name))

        ways = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if not rounds:
            # Only the first round has links to nothing: the node's own.
            ways = ways.withColumn("b", F.when(F.col("a").isNotNull(), F.coalesce("b", "a")))
        least = ways.groupBy("a").agg(F.min(priority("b")).alias("least"), F.min_by("b", priority("b")).alias("new"), F.count("*").alias("links"))
        moves = pin(least.select(F.col("a").alias("old"), F.when(F.col("least") < priority("a"), F.col("new")).otherwise(F.col("a")).alias("new"), "links"))
        # Each link counts for two nodes: at most 2 / HOT_SHARE are hot.
        hot = [r.old for r in moves.where((F.col("links") >= max(HOT_LINKS, HOT_SHARE * left)) & F.col("old").isNotNull()).select("old").collect()]
        rounds.append((moves.select(F.col("old").alias("node"), F.col("new").alias("root")), hot))
        to = moves.where("old <> new")
        edges = _moved(_moved(edges, "a", to, hot, "b"), "b", to, hot, "a").where("a <> b")
        edges = pin(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        left = edges.count()
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots, _ = rounds.pop()
    while rounds:
        last = roots.withColumnsRenamed({"node": "old", "root": "new"})
        moves, hot = rounds.pop()
        roots = _moved(moves, "root", last, hot, "node").select("node", "root")
    return pin(roots)
