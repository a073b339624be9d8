"""Connected components of a large undirected graph by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import fresh_folder, store


def _star(links: DataFrame, centre: DataFrame) -> DataFrame:
    """Links from each node's neighbours to the smallest node of its neighbourhood."""
    return (
        links.join(centre, "a")
        .select(F.greatest("b", "least").alias("a"), F.least("b", "least").alias("b"))
        .where("a <> b")
    )


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> one row per node that has a link: ``node``, ``component`` (its smallest node).

    Large-star and small-star rounds (alternating) until every node points at the smallest of its
    component. A round is an aggregate and a join whose hot keys can be split; nothing is gathered
    per node. Every round is written, and only two sums come to the driver.
    """
    spark = links.sparkSession
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = store(now, fresh_folder(spark, "links"))
    # a link is (larger, smaller); its hash sum shows whether a round changed anything
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.count(F.lit(1))
    before = tuple(now.agg(*mark).first())
    while before[1]:
        # large star: larger neighbours go to the smallest neighbour
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = _star(both.where("b > a"), least).distinct()
        large = store(large, fresh_folder(spark, "links"))
        # small star: smaller neighbours, and the node itself, go to the smallest
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = _star(large, least).unionByName(least.select("a", F.col("least").alias("b"))).distinct()
        now = store(small, fresh_folder(spark, "links"))
        after = tuple(now.agg(*mark).first())
        if after == before:
            break
        before = after
    stars = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())
