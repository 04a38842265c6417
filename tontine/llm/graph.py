"""Connected components of a link table, without collecting any part of it.

Alternating large-star and small-star steps: every step only groups and joins
links by node, replaces each link by one to a smaller node and never adds links
(beyond one a node), so a component of any size and shape ends as a star around
its smallest node.  A hub's links are pre-aggregated to their minimum, which is dealt
on its own before it is joined back: so both sides of the join are plain exchanges,
and Spark splits a skewed hub (it does not with an aggregate in between).  Each round
is a written table, so a lost executor costs no more than its own tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tontine.llm.batches import partitions
from tontine.sources.sinks import materialize


def dealt(rows: DataFrame) -> DataFrame:
    """An aggregate's rows in an exchange of their own, so that AQE can split the other side of a join with them."""
    return rows.repartition(partitions(rows.sparkSession))


def _toward_least(links: DataFrame) -> DataFrame:
    """Links (u, v): each v of u points to the smallest of u's neighbours and u itself."""
    least = dealt(links.groupBy("u").agg(F.min("v").alias("m")))
    return links.join(least, "u").select("u", "v", F.least("u", "m").alias("m"))


def _round(links: DataFrame) -> DataFrame:
    """One large star and one small star over links with u > v."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _toward_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    small = _toward_least(large)
    return (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v"))).filter("u > v").distinct())


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node that has a link in ``links`` (a, b): the component is
    the smallest node reachable.  Nodes are integers; links of a node with itself or a null
    are left out; without links the result is empty."""
    now = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                      .filter("u > v and a is not null and b is not null").distinct(), name=f"{name}-0")
    state, step = None, 0
    while True:
        mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if mark == state or mark[0] == 0:
            break
        state, step = mark, step + 1
        now = materialize(_round(now), name=f"{name}-{step}")
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
