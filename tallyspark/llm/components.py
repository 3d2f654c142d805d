"""Connected components of an edge table, by alternating star contractions.

Every round is two joins on node ids. Rounds are written to the shared folder, so
the plan stays short and a lost executor costs its tasks only. No edge list,
label or component ever reaches the driver.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyspark.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: any ordered type); label is the least node reachable.

    Self loops and repeated edges are ignored, edges with a null end are dropped.
    Nodes without an edge have no row. An empty table gives an empty table.
    """
    current = cut_lineage(_distinct(edges.where("a is not null and b is not null and a <> b")))
    known = None
    while True:
        current = cut_lineage(_distinct(_small_star(_large_star(current))))
        state = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == known or not state[0]:
            break
        known = state
    leaves = current.select(F.col("a").alias("node"), F.col("b").alias("label"))
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return leaves.unionByName(roots)


def _distinct(edges):
    """Edges from the larger to the smaller node, each once."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges):
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges):
    """A node and its smaller neighbours are linked to the least of them."""
    edges = _distinct(edges.where("a <> b"))
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(least, "a")
    moved = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b")))
