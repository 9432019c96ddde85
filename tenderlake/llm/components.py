"""Connected components of links by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenderlake.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): every linked node with the smallest node it can reach.

    ``links`` has long columns ``a`` and ``b``; repeated, reversed and self links do no harm.
    Each round points every node at its smallest neighbour, itself included, follows these pointers
    to their ends by doubling, and renames both ends of the links after them. Only nodes smaller
    than all their neighbours remain, so a chain goes in one round if its ids rise, however
    long it is (tested), and a star in two. The smallest node of a component only ever points at
    itself, so it is the one that remains. Rounds are written to the shared folder; a node's links never
    meet in one task, only their minimum does, of which each map task sends one row.
    """
    links = links.filter("a != b")
    links = materialize(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    steps = []
    while not links.isEmpty():
        step = _followed(materialize(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("to"))))
        steps.append(step)
        links = materialize(
            links.join(step.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
            .filter("a2 != b2")
            .select(F.col("a2").alias("a"), F.col("b2").alias("b"))
            .distinct()
        )
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        after = step.select(F.col("node").alias("root"), F.col("to"))
        found = found.join(after, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return found


def _followed(step: DataFrame) -> DataFrame:
    """(node, to) with every pointer led on to a node that points at itself; a round halves the longest way."""
    while True:
        onward = step.filter("node != to").select(F.col("node").alias("to"), F.col("to").alias("after"))
        led = materialize(step.join(onward, "to", "left").select("node", F.coalesce("after", "to").alias("to"), F.col("after").isNotNull().alias("moved")))
        step = led.select("node", "to")
        if led.filter("moved").isEmpty():
            return step
