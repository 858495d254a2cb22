"""Connected components of links by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import measure, row_count, small, stored


def _both(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame, nodes: int) -> DataFrame:
    """Each node links its larger neighbours to the smallest of itself and its neighbours."""
    near = _both(edges)
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = near.filter("v > u").join(small(least, nodes), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v")


def _small_star(edges: DataFrame, nodes: int) -> DataFrame:
    """Each node links itself and its smaller neighbours to the smallest of them; edges have v < u."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(small(least, nodes), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, component) of all linked nodes, the component being its smallest node.

    Links to itself and NULL ends are ignored; a table without links gives no rows. Rounds end
    when the edges no longer change; each round's edges are written to the shared folder.
    """
    up, down = F.greatest(a, b), F.least(a, b)
    edges = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(up.alias("u"), down.alias("v"))
    content = F.bit_xor(F.xxhash64("u", "v"))
    edges = stored(edges.filter("u <> v").distinct(), content=content)
    before = None
    while True:
        state = row_count(edges), measure(edges, "content")
        if state == before or not state[0]:
            break
        before = state
        nodes = 2 * state[0]  # at most
        edges = stored(_small_star(stored(_large_star(edges, nodes)), nodes), content=content)
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
