"""Connected components of a graph given as a table of edges.

Each round every node points to its smallest neighbour, chains of pointers are shortened by doubling,
and the graph is contracted to the nodes that still point to themselves. All of it is joins and
aggregates; each step is written to the shared folder, and only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, root) for every node that has an edge; root is the smallest node reachable.

    ``edges`` has the columns a and b; order, repeats and loops do not matter. Rows with a null end
    are ignored. Without edges the result is empty.
    """
    step = 0

    def put(what: str, df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        return scratch.put(f"{name}-{step}-{what}", df)

    used = edges.where("a is not null and b is not null").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    used = put("edges", used.distinct())
    roots = None
    while True:
        both = used.unionAll(used.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = put(
            "parents",
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")),
        )
        while True:
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            jumped = put("jumped", parents.join(above, "root").select("node", "root", "higher"))
            moved = jumped.where("root <> higher").limit(1).count()
            parents = jumped.select("node", F.col("higher").alias("root"))
            if not moved:
                break
        if roots is None:
            roots = parents
        else:
            then = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            roots = roots.join(then, "root", "left").select(
                "node", F.coalesce("higher", "root").alias("root")
            )
        roots = put("roots", roots)
        left = parents.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
        right = parents.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
        used = put(
            "edges",
            used.join(left, "a").join(right, "b").where("root_a <> root_b")
            .select(F.least("root_a", "root_b").alias("a"), F.greatest("root_a", "root_b").alias("b"))
            .distinct(),
        )
        if used.isEmpty():
            return roots
