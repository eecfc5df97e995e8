"""Connected components of an undirected graph by repeated contraction.

Each round gives every node the least of itself and its neighbours (one
aggregation with map-side combine, so a hub's edges meet as one partial row a
task) and replaces both ends of every edge by what they were given. Even rounds
compare the ids themselves: a star whose hub is its least id, which is what the
callers emit, vanishes at once. Odd rounds compare salted hashes of the ids,
which shrinks long chains by a constant factor whatever their order. Rounds
end when no edge is left; ``max_rounds`` only guards against a bug.

The graph and the maps live in Parquet tables in the checkpoint folder. The
driver sees one row count a round, no node, edge or component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch


def connected_components(edges: DataFrame, a: str, b: str, max_rounds: int = 200) -> DataFrame:
    """(node, label) for every node that has an edge; nodes share a label if and
    only if they are connected. The label is some node of the component.

    Null ends and loops are ignored, repeated edges count once. No edges: no rows.
    """
    spark = edges.sparkSession
    scratch = Scratch(spark, "components")
    e = scratch.keep(
        edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") < F.col("b"))).distinct(), "edges")
    maps: list[DataFrame] = []
    while e.count():
        k = len(maps)
        if k >= max_rounds:
            raise RuntimeError(f"components: {k} rounds and still edges")
        rank = (lambda c: F.struct(F.lit(0).alias("h"), c.alias("v"))) if k % 2 == 0 else \
            (lambda c, k=k: F.struct(F.xxhash64(c, F.lit(k)).alias("h"), c.alias("v")))
        both = e.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            e.select(F.col("b").alias("node"), F.col("a").alias("other")))
        near = both.groupBy("node").agg(F.min(rank(F.col("other"))).alias("m"))
        given = scratch.keep(
            near.select("node", F.least(F.col("m"), rank(F.col("node")))["v"].alias("parent")), f"map{k}")
        maps.append(given)
        to_a = given.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        to_b = given.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        after = e.join(to_a, "a").join(to_b, "b").where("pa != pb")
        shrunk = scratch.keep(
            after.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), f"edges{k}")
        scratch.drop(e)
        e = shrunk
    if not maps:
        return e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    out = maps[0].select("node", F.col("parent").alias("label"))
    for m in maps[1:]:
        step = m.select(F.col("node").alias("label"), "parent")
        out = out.join(step, "label", "left").select("node", F.coalesce("parent", "label").alias("label"))
    return out


def least_of_component(labels: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(node, least): the smallest ``value`` over all nodes of a node's component.
    ``values`` has one row per node, and has every node that has a label."""
    v = labels.join(values.select("node", value), "node")
    least = v.groupBy("label").agg(F.min(value).alias("least"))
    return v.select("node", "label").join(least, "label").select("node", "least")
