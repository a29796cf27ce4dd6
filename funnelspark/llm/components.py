"""Connected components of links between documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.sources.sinks import via_shared_table


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that has a link in (a, b).

    Each round points every node to the smallest of itself and its neighbours, follows pointers to
    their ends by doubling, and replaces links by those between ends. Rounds and doublings grow with
    the logarithm of the longest chain.
    """
    links = via_shared_table(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    labels = None
    while not links.isEmpty():
        ends = links.selectExpr("inline(array(struct(a as node, b as to), struct(b as node, a as to)))")
        to = via_shared_table(ends.groupBy("node").agg(F.least("node", F.min("to")).alias("to")), "pointers")
        while True:
            further = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = to.join(further, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved"))
            jumped = via_shared_table(jumped, "pointers")
            to = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        if labels is None:
            labels = to.withColumnRenamed("to", "component")
        else:
            moved = to.select(F.col("node").alias("component"), "to")
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        labels = via_shared_table(labels, "labels")
        first, second = (to.withColumnsRenamed({"node": c, "to": f"{c}_to"}) for c in "ab")
        between = links.join(first, "a").join(second, "b").where("a_to != b_to")
        links = via_shared_table(
            between.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), "links"
        )
    return labels if labels is not None else links.select(F.col("a").alias("node"), F.col("b").alias("component"))
