"""Connected components of a link table, by hooking and contraction."""

from pyspark.sql import DataFrame, functions as F

from ..session import durable


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every end of a link (a, b); `component` is the smallest id reachable.

    Each round points a node at its smallest neighbour, follows the pointers
    two steps and contracts the links to the nodes pointed at; the smallest id
    of a component always survives. Links, pointers and labels are written to
    the shared folder, so a lost executor repeats one step of one round.
    Null ends and self links are ignored; no link gives no row.
    """
    edges = durable(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a < b").distinct())
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        points = durable(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        for _ in range(2):
            onward = points.select(F.col("a").alias("m"), F.col("m").alias("further"))
            points = points.join(onward, "m").select("a", F.col("further").alias("m"))
        points = durable(points)
        if labels is None:
            labels = points.select(F.col("a").alias("id"), F.col("m").alias("component"))
        else:
            moved = points.select(F.col("a").alias("component"), "m")
            labels = durable(labels.join(moved, "component", "left").select(
                "id", F.coalesce("m", "component").alias("component")))
        ends = edges.join(points.withColumnRenamed("m", "to_a"), "a")
        ends = ends.join(points.select(F.col("a").alias("b"), F.col("m").alias("to_b")), "b")
        edges = durable(
            ends.where("to_a != to_b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct())
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
