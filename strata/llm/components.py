"""Connected components by alternating large and small stars.

Every round is two joins over staged edges; a vertex with very many edges is split by the
join, its least neighbour is found by a partial aggregate. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.session import staged

# Rows of two numbers that a task joins or writes.
EDGES_PER_TASK = 200_000


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its least node, for every node that has an edge.

    ``edges``: a, b, whole numbers; direction, repeats and loops do not matter.
    """
    spark = edges.sparkSession
    now = edges.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct()
    now, before = staged(spark, now, "edges"), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            break
        before = state
        # As many tasks as the edges need, not as many as the session deals a shuffle to.
        tasks = 8 + state[0] // EDGES_PER_TASK

        def kept(df: DataFrame, label: str, tasks: int = tasks) -> DataFrame:
            return staged(spark, df.coalesce(tasks), label)

        both = now.union(now.select(F.col("v"), F.col("u")))
        least = kept(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = kept(large.distinct(), "large-star")
        lower = kept(large.groupBy("u").agg(F.min("v").alias("m")), "lower")
        hung = large.join(lower, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = kept(hung.union(lower.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    # Every node hangs on its root now, and a root on nothing.
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
