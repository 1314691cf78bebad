"""Connected components of links by alternating large-star and small-star steps.

Each step replaces links by links to the smallest neighbour. It shuffles links by node with
a map-side minimum, gathers no neighbourhood in a task, and writes its result, so lost
executors cost the running step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engagemart.llm.common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Links (_u, _v), _u > _v, after one step."""
    both = links.unionByName(links.select(F.col("_v").alias("_u"), F.col("_u").alias("_v")))
    seen = both if large else links
    least = seen.groupBy("_u").agg(F.min("_v").alias("_m")).withColumn("_m", F.least("_m", "_u"))
    if large:  # every larger neighbour goes to the smallest of the neighbourhood
        moved = both.filter("_v > _u").join(least, "_u").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
    else:  # the node and its smaller neighbours go to the smallest of them
        moved = links.join(least, "_u").filter("_v != _m").select(F.col("_v").alias("_u"), F.col("_m").alias("_v"))
        moved = moved.unionByName(least.select("_u", F.col("_m").alias("_v")))
    return moved.filter("_u != _v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(_node, _component): the smallest node reachable, for every node that has a link.

    ``links`` has two columns of integers; direction, repeats and links of a node to itself do not matter.
    """
    a, b = links.columns
    state = links.select(F.greatest(a, b).alias("_u"), F.least(a, b).alias("_v"))
    state = written(state.filter("_u != _v").distinct(), "links")
    print_ = F.struct(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("_u", "_v").cast("decimal(38,0)")), F.lit(0)))
    last = state.agg(print_).head()[0]
    while last[0]:
        state = written(_star(written(_star(state, large=True), "links"), large=False), "links")
        now = state.agg(print_).head()[0]
        if now == last:
            break
        last = now
    roots = state.select(F.col("_v").alias("_node"), F.col("_v").alias("_component")).distinct()
    return state.select(F.col("_u").alias("_node"), F.col("_v").alias("_component")).unionByName(roots)
