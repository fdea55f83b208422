"""Connected components by alternating large and small stars.

Each round hangs neighbours under smaller nodes; the number of rounds grows with the logarithm of the longest path. All
steps are joins and aggregates over tables in the shared folder, and end when every component is one star. Neighbour minima are written before they are joined, so
both sides of each join are plain shuffles that Spark can split where a node has very many neighbours.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

MOST_ROUNDS = 60
#: Once their number is known, edges are written by tasks of about so many rows, and by so many tasks at least.
ROWS, FEWEST = 4096, 8


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a`` and ``b``): the smallest node it is connected with.

    Loops, repeats and null ends change nothing; no edges give an empty result. Raises if 60 rounds do not suffice.
    """
    edges = stored(_downward(edges.filter("a <> b").select("a", "b")).distinct(), "edges")
    for _ in range(MOST_ROUNDS):
        rows, open_nodes = _state(edges)
        if not open_nodes:
            roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
        tasks = max(FEWEST, rows // ROWS)
        edges = stored(_large_star(edges, tasks).coalesce(tasks), "edges")
        edges = stored(_small_star(edges, tasks).coalesce(tasks), "edges")
    raise RuntimeError("components did not settle")


def _state(edges: DataFrame) -> tuple[int, int]:
    """The number of edges, and of nodes that hang under several nodes or under one that hangs itself: none of stars."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("end"))
    nodes = ends.groupBy("end.node").agg(F.sum("end.up").alias("up"), F.count("*").alias("ends"))
    found = nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 0) & (F.col("ends") > 1))).first()
    return found[0], found[1]


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge from its larger end ``a`` to its smaller end ``b``."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def _minima(edges: DataFrame, tasks: int) -> DataFrame:
    return stored(edges.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("low")).coalesce(tasks), "minima")


def _large_star(edges: DataFrame, tasks: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = F.least("low", "at")
    return both.join(_minima(both, tasks), F.col("a") == F.col("at")).filter("b > a").select(F.col("b").alias("a"), low.alias("b")).distinct()


def _small_star(edges: DataFrame, tasks: int) -> DataFrame:
    joined = edges.join(_minima(edges, tasks), F.col("a") == F.col("at"))
    moved = joined.filter("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.unionByName(joined.select("a", F.col("low").alias("b"))).distinct()
