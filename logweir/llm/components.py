"""Connected components of a table of links, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, stored


def connected_components(links: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, root) for every node of links, root the smallest node reachable. No links: no rows.

    Minimum hooking with pointer jumping: each round a node takes the least label of its neighbours, the root of a
    label takes the least label that any of its members saw, and labels then jump to their own labels. Rounds grow with
    the logarithm of the longest path, not with it. All state is one row for each linked node, written to the shared
    folder each round; a node with many links is only a key of a pre-aggregated minimum. Links with a null end are
    ignored.
    """
    pairs = links.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null and a <> b")
    both = stored(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        seen = both.join(label.select(F.col("node").alias("b"), F.col("root").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"))
        least = label.join(seen.withColumnRenamed("a", "node"), "node").select("node", "root", F.least("root", "other").alias("least"))
        hooks = least.groupBy("root").agg(F.min("least").alias("hook"))
        hooked = least.join(hooks, "root").select("node", F.col("root").alias("was"), F.least("least", "hook").alias("mid"))
        jump = hooks.select(F.col("root").alias("mid"), F.col("hook").alias("far"))
        after = stored(hooked.join(jump, "mid", "left").select("node", "was", F.least("mid", F.coalesce("far", "mid")).alias("root")), "labels")
        changed = after.filter("was <> root").limit(1).count()
        forget(label)
        label = after
        if not changed:
            forget(both)
            return label.select("node", "root")
