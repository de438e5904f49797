"""Connected components of a link table by contraction in random order.

Each round every node hooks to the smallest of its neighbours and itself, in an order drawn anew for the
round; links are then rewritten between the chosen nodes, and links inside one node and repeated links go. Nothing gathers the links
of a node: the smallest neighbour is a map-side combined minimum, and the rewriting is an inner join whose
hot keys adaptive execution can split. The number of rounds grows with the logarithm of the component size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from depositlens.llm.common import forget, settle


def components(links: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, label) for each node of ``links`` (x, y: long), equal labels within a component.

    Also returns the settled tables that the result reads. No links: no rows. Links of a node to itself and
    repeated links change nothing; NULL ends are not links.
    """
    rest = settle(
        links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .where("x < y")
        .distinct(),
        "links",
    )
    labels, kept, turn = None, [], 0
    while labels is None or not rest.isEmpty():
        both = rest.union(rest.select("y", "x"))
        order = lambda node: F.struct(F.xxhash64(F.lit(turn), node).alias("h"), F.col(node).alias("node"))  # noqa: B023, E731
        parents = settle(
            both.groupBy("x")
            .agg(F.min(order("y")).alias("least"))
            .select(F.col("x").alias("child"), F.least("least", order("x"))["node"].alias("parent")),
            "parents",
        )
        kept.append(parents)
        if labels is None:
            labels = parents.select(F.col("child").alias("node"), F.col("parent").alias("label"))
        else:
            labels = labels.join(parents, labels["label"] == parents["child"], "left").select(
                "node", F.coalesce("parent", "label").alias("label")
            )
        low = parents.select(F.col("child").alias("x"), F.col("parent").alias("low"))
        high = parents.select(F.col("child").alias("y"), F.col("parent").alias("high"))
        merged = (
            rest.join(low, "x")
            .join(high, "y")
            .select(F.least("low", "high").alias("x"), F.greatest("low", "high").alias("y"))
            .where("x < y")
            .distinct()
        )
        old, rest = rest, settle(merged, "links")
        forget(old)
        turn += 1
    forget(rest)
    return labels, kept
