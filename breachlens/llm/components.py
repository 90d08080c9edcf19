"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer


def _hook(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node are tied to its smallest neighbour (or itself)."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _lift(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def component_roots(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node with an edge can reach, if it is another one.

    ``edges`` has two columns of one type. Alternates between tying the larger neighbours of each
    node to its smallest one and lifting nodes to the smallest below them, until all edges
    form stars: rounds grow with the logarithm of the nodes. A node's neighbours are only ever
    reduced to their smallest, so no list of neighbours is built. Each round is written, which
    cuts its lineage.
    """
    folder, before = new_folder(spark, "components"), None
    a, b = edges.columns
    # written first: a round reads its edges several times
    edges = write_layer(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"), f"{folder}/edges")
    for step in range(100):
        edges = write_layer(_lift(_hook(edges)), f"{folder}/{step:03d}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
    raise RuntimeError("The components did not settle")
