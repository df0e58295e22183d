"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablesmith.llm.storage import saved


def _priority(node: Column, step: int) -> Column:
    """Order in which nodes absorb their neighbours: by id at first (stars end at once), then
    random and new in every round, which shrinks any graph by a constant factor."""
    return node if step < 2 else F.xxhash64(node, F.lit(step))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long).

    ``component`` is the smallest node that can be reached. Each round every node points to
    the neighbour of least priority (or itself), and the edges are rewritten to those; the
    minimum over neighbours is combined on the map side, so a hub is no hot key. Rows with a
    null end and loops are ignored; an empty table gives an empty result.
    """
    links = saved(edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
                  .where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .distinct(), "edges")
    roots, step = None, 0
    while roots is None or not links.isEmpty():
        both = links.union(links.select("b", "a"))
        ranked = F.struct(_priority(F.col("b"), step).alias("p"), F.col("b").alias("n"))
        own = F.struct(_priority(F.col("a"), step).alias("p"), F.col("a").alias("n"))
        parents = saved(both.groupBy("a").agg(F.min(ranked).alias("m"))
                        .select(F.col("a").alias("node"), F.least("m", own)["n"].alias("parent")), "parents")
        if roots is None:
            roots = parents.withColumnRenamed("parent", "root")
        else:
            roots = saved(roots.join(parents, F.col("root") == parents["node"], "left")
                          .select(roots["node"], F.coalesce("parent", "root").alias("root")), "roots")
        up_a = parents.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        up_b = parents.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        links = saved(links.join(up_a, "a").join(up_b, "b").where("pa <> pb")
                      .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        step += 1
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"))
    return saved(roots.join(smallest, "root").select("node", "component"), "components")
