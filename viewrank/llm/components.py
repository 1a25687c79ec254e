"""Connected components over links, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewrank.llm.common import kept_table


def _large_star(links: DataFrame) -> DataFrame:
    """Hangs every larger neighbour of a node on its smallest neighbour (or itself)."""
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
    return (
        both.join(least, "node")
        .filter("root > node")
        .select(F.col("root").alias("node"), F.col("least").alias("root"))
        .filter("node != root")
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Hangs a node and its smaller neighbours on the smallest of them. Links lead from larger to smaller."""
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    others = links.join(least, "node").select(F.col("root").alias("node"), F.col("least").alias("root"))
    own = least.select("node", F.col("least").alias("root"))
    return others.unionByName(own).filter("node != root").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node, root` for linked nodes, root being the smallest node of the component (a node is no row of its own root).

    `links` has two long columns `node, root`, in any direction. Each round writes its links, so lineage
    stays short; components of any shape end after about log(n) rounds.
    """
    links = kept_table(
        links.select(F.greatest("node", "root").alias("node"), F.least("node", "root").alias("root"))
        .filter("node != root")
        .distinct(),
        "links",
    )
    before = None
    while (now := _fingerprint(links)) != before:
        if now[0] == 0:
            break
        before = now
        links = kept_table(_small_star(_large_star(links)), "links")
    return links


def _fingerprint(links: DataFrame) -> tuple:
    mark = F.xxhash64("node", "root").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(mark)).first())
