"""Connected components of a table of links, by alternating star contraction.

Every step is joins and grouped minima, so that a node with very many links is folded before the
shuffle; each round is written to the shared folder. Rounds grow with the logarithm of the
longest chain of links.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.session import materialise


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One contraction of (big, little) links, big > little.

    Large star: each node hands its least neighbour to its larger neighbours. Small star: to its
    smaller ones and itself.
    """
    both = links if small else links.unionByName(links.select(F.col("little").alias("big"), F.col("big").alias("little")))
    least = both.groupBy("big").agg(F.min("little").alias("least")).withColumnRenamed("big", "node")
    if small:
        moved = links.join(least, F.col("big") == F.col("node")).select(F.col("little").alias("big"), F.col("least").alias("little"))
        moved = moved.where("big > little").unionByName(least.select(F.col("node").alias("big"), F.col("least").alias("little")))
    else:
        # A node's larger neighbours are the big ends of links in which it is the little end.
        moved = links.join(least, F.col("little") == F.col("node")).select("big", F.least("least", "little").alias("little"))
    return moved.distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node with a link to another; the component is its least node.

    Repeated links, links in both directions and links of a node to itself are allowed; null ends
    are left out. An empty table has no nodes.
    """
    one, two = F.col(a), F.col(b)
    now = links.where(one.isNotNull() & two.isNotNull() & (one != two))
    now = materialise(now.select(F.greatest(one, two).alias("big"), F.least(one, two).alias("little")).distinct())
    state = None
    while True:
        told = now.agg(F.count("*"), F.sum(F.xxhash64("big", "little").cast("decimal(38,0)"))).first()
        if not told[0] or tuple(told) == state:
            break
        state = tuple(told)
        now = materialise(_star(_star(now, small=False), small=True))
    roots = now.select(F.col("little").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("big").alias("node"), F.col("little").alias("component")).unionByName(roots)
