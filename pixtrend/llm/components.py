"""Connected components of an edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixtrend.llm.scratch import materialise


def _jump(parent: DataFrame) -> DataFrame:
    """v -> parent(parent(v)); a vertex without a row is its own parent."""
    up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
    return parent.join(up, "p", "left").select("v", F.coalesce("pp", "p").alias("p"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(v, root)`` for every vertex of ``edges``; root is the smallest vertex
    of its component.

    Each round hooks every vertex to its smallest neighbour, jumps pointers
    until they rest on local minima, and contracts the edges to those; at least
    half of the vertices go in a round.  Tables are written to the shared
    folder after each step, so no lineage grows and nothing visits the driver.
    Loops and repeated edges are harmless; edges with a null end are ignored;
    no edges give no rows.
    """
    def proper(e: DataFrame) -> DataFrame:
        return e.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    e = materialise(proper(edges.select(F.col(a).alias("a"), F.col(b).alias("b"))), "edges")
    total = None
    while not e.isEmpty():
        # only vertices with a smaller neighbour get a parent; the others are local minima
        parent = materialise(e.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")), "parent")
        while True:
            moved = materialise(_jump(parent), "parent")
            same = moved.join(parent.withColumnRenamed("p", "old"), "v").where(F.col("p") != F.col("old")).isEmpty()
            parent = moved
            if same:
                break
        to = lambda c: parent.select(F.col("v").alias(c), F.col("p").alias(f"{c}_p"))  # noqa: E731, B023
        e = materialise(proper(e.join(to("a"), "a", "left").join(to("b"), "b", "left")
                               .select(F.coalesce("a_p", "a").alias("a"), F.coalesce("b_p", "b").alias("b"))), "edges")
        if total is None:
            total = parent
        else:
            step = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
            total = materialise(total.join(step, "p", "left").select("v", F.coalesce("pp", "p").alias("p"))
                                .unionByName(parent.join(total.select("v"), "v", "left_anti")), "labels")
    if total is None:
        return e.select(F.col("a").alias("v"), F.col("b").alias("root"))
    roots = total.select(F.col("p").alias("v")).distinct().join(total.select("v"), "v", "left_anti")
    return materialise(total.select("v", F.col("p").alias("root")).unionByName(roots.select("v", F.col("v").alias("root"))), "components")
