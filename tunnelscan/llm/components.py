"""Connected components of a link table, by contraction.

Every round points each node to the smallest of itself and its neighbours and
then contracts the links to those nodes; links inside a component vanish.  Each
round is two joins on thin staged rows; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the smallest node) for the nodes of ``links``.

    NULL ends and loops are left out; repeated links count once; without links
    the result is empty.
    """
    edges = stage(links.select(F.col(a).alias("a"), F.col(b).alias("b"))
                  .where("a is not null and b is not null and a <> b").distinct(), "links")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().select(
        "node", F.col("node").alias("component"))
    rounds = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        down = stage(both.groupBy("a").agg(F.min("b").alias("m"))
                     .select("a", F.least("a", "m").alias("m")), "hooks")
        labels = labels.join(down.withColumnRenamed("a", "component"), "component", "left").select(
            "node", F.coalesce("m", "component").alias("component"))
        labels = stage(labels, "labels") if rounds % 2 else labels
        ends = down.select(F.col("a").alias("b"), F.col("m").alias("n"))
        edges = stage(edges.join(down, "a").join(ends, "b").where("m <> n")
                      .select(F.least("m", "n").alias("a"), F.greatest("m", "n").alias("b")).distinct(), "links")
        rounds += 1
    return stage(labels, "labels")
