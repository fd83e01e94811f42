"""Connected components by repeated contraction, for links of any number and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.workspace import staged


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of ``links``; the component is its smallest node.

    Each round every node joins the smaller of itself and its least neighbour,
    chains are followed one step further, and the links are redrawn between what
    is left; a round at least halves the nodes of every component. The least
    node of a component never moves, so it is what remains. Each round is
    written to the shared folder. Least neighbours are found with map-side
    minima, and links are redrawn by joins whose hot sides adaptive execution
    can split. Null ends, loops and repeated links do no harm.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    links = staged(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), "links")
    where = None
    while not links.isEmpty():
        both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(
            links.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        step = staged(both.groupBy("node").agg(F.min("to").alias("to")).select("node", F.least("node", "to").alias("to")), "step")
        ahead = step.select(F.col("node").alias("to"), F.col("to").alias("far"))
        step = staged(step.join(ahead, "to").select("node", F.col("far").alias("to")), "step")
        if where is None:
            where = step.select("node", F.col("to").alias("component"))
        else:
            moved = step.select(F.col("node").alias("component"), "to")
            where = where.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        where = staged(where, "components")
        left = step.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        right = step.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        links = (
            links.join(left, "a").join(right, "b").where("a2 != b2")
            .select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct()
        )
        links = staged(links, "links")
    if where is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return where
