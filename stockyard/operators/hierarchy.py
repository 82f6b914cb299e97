"""Trees of any depth by pointer doubling.

Each node keeps a pointer to an ancestor and what lies between. One round joins a node to its
ancestor's row and doubles the distance, so depth D takes log2(D) joins instead of D. Nodes whose
chain of parents ends outside the table drop out, and nodes on a cycle are never rooted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.session import materialize


def rooted(nodes: DataFrame, node: str, parent: str, label: str | None = None, separator: str = " > ") -> DataFrame:
    """Nodes that hang on a root, with ``depth`` (root = 1) and, if labelled, ``full_path``."""
    path = F.col(label) if label else F.lit(None).cast("string")
    links = materialize(
        nodes.select(
            F.col(node).alias("node"),
            F.col(parent).alias("up"),
            F.lit(1).alias("hops"),
            path.alias("path"),
        )
    )
    done = links.filter("up is null")
    waiting = links.filter("up is not null")
    while not waiting.isEmpty():
        above = done.unionByName(waiting).select(
            F.col("node").alias("at"),
            F.col("up").alias("next"),
            F.col("hops").alias("more"),
            F.col("path").alias("prefix"),
        )
        # Many nodes may share one ancestor; that side of the join is splittable, the other unique.
        moved = materialize(
            waiting.join(above, waiting.up == above["at"]).select(
                "node",
                F.col("next").alias("up"),
                (F.col("hops") + F.col("more")).alias("hops"),
                F.concat("prefix", F.lit(separator), "path").alias("path"),
            )
        )
        arrived = moved.filter("up is null")
        if arrived.isEmpty():
            break  # a rooted node one level further down would have arrived: the rest is cyclic
        done = done.unionByName(arrived)  # each part is already written
        waiting = moved.filter("up is not null")
    columns = [F.col("hops").cast("bigint").alias("depth")]
    if label:
        columns.append(F.col("path").alias("full_path"))
    found = done.select(F.col("node").alias(node), *columns)
    return nodes.join(found, node)
