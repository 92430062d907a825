"""Connected components of links in tables, for groups of any size."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link: the component is its smallest reachable node.

    Every round each node takes its smallest neighbour, if that is smaller; the chains that this makes are followed to
    their ends by doubling; then the links are redrawn between the ends, and loops and repeats go. A node that
    is no end has met a smaller one, so at least every second node of a component goes in each round. No row ever
    holds a list of neighbours, and the sums of a popular node are formed before the shuffle. Each step is a table in
    the shared folder; the driver sees counts only. Null ends and loops are no links.
    """
    links = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
                   .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("a") < F.col("b"))).distinct(), "links")
    found = None
    while not links.isEmpty():
        ends = links.select(F.col("b").alias("node"), F.col("a").alias("to")).unionAll(
            links.select(F.col("a").alias("node"), F.col("a").alias("to")))
        hooks = stored(ends.groupBy("node").agg(F.min("to").alias("to")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("to"), F.col("to").alias("next"))
            jumped = stored(hooks.join(up, "to", "left").select("node", F.coalesce("next", "to").alias("to"),
                                                                (F.col("next") != F.col("to")).alias("moved")), "hooks")
            hooks = jumped.select("node", "to")
            if jumped.where("moved").isEmpty():
                break
        if found is None:
            found = hooks.select("node", F.col("to").alias("component"))
        else:
            up = hooks.select(F.col("node").alias("component"), "to")
            found = stored(found.join(up, "component", "left")
                           .select("node", F.coalesce("to", "component").alias("component")), "components")
        low = hooks.select(F.col("node").alias("a"), F.col("to").alias("x"))
        high = hooks.select(F.col("node").alias("b"), F.col("to").alias("y"))
        links = stored(links.join(low, "a").join(high, "b")
                       .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                       .where("a < b").distinct(), "links")
    if found is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return found
