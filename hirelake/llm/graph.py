"""Connected components of a link table, on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every id in ``links`` (a, b).

    Smallest labels spread along links, each round written to the shared
    folder, until none changes; every fourth round a label is also replaced by
    its own label, so that long chains shorten. A star, whatever its size,
    takes two rounds. Minima combine before the shuffle, and the joins are
    plain ones that AQE splits at a frequent id."""
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels = materialize(both.unionByName(both.select("a", F.col("a").alias("b"))).groupBy(F.col("a").alias("id"))
                         .agg(F.min("b").alias("component")), "labels")
    state, turn = None, 0
    while True:
        known = labels.agg(F.bit_xor(F.xxhash64("id", "component"))).first()[0]
        if known == state:  # also when there are no links
            return labels
        state, turn = known, turn + 1
        spread = both.join(labels.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "component")
        lower = labels.unionByName(spread)
        if turn % 4 == 0:
            own = labels.select(F.col("id").alias("component"), F.col("component").alias("far"))
            lower = lower.unionByName(labels.join(own, "component").select("id", F.col("far").alias("component")))
        labels = materialize(lower.groupBy("id").agg(F.min("component").alias("component")), "labels")
