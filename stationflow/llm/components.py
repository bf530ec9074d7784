"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .steps import stored


def components(edges: DataFrame, folder: str, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component``: each node of an edge, and the least node it reaches.

    Rounds of large-star and small-star: every node points its greater neighbours,
    then its lesser ones, at the least of them, until nothing moves; about log(n)
    rounds. All steps are minima per node and joins, so a node with very many
    neighbours is combined before it is shuffled; merge joins, as a broadcast would
    bring links to the driver. Each round is written below
    ``folder`` and read again: a lost executor costs a re-read. Null ends and loops
    are no edges; an edge may be given often and either way round.
    """
    kind = edges.schema[a].dataType
    now = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).where("v > u").distinct()
    before = None
    for turn in range(1, 200):
        both = now.select("v", "u").union(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        # Large star: neighbours above v go to the least around v.
        large = both.join(least.hint("merge"), "v").where("u > v").select(F.col("u").alias("v"), F.col("m").alias("u")).where("v > u").distinct()
        # Small star: neighbours below v, and v, go to the least of them.
        floor = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(floor.hint("merge"), "v").where("u > m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        small = small.union(floor.select("v", F.col("m").alias("u"))).distinct()
        seen = Observation()
        looked = small.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("sum"))
        now = stored(looked, f"{folder}/round-{turn}")
        state = dict(seen.get)
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components: no end after 200 rounds")
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return now.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots).distinct().select(
        F.col("node").cast(kind), F.col("component").cast(kind)
    )
