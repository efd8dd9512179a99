"""Connected components of a link table by alternating large-star and
small-star rounds.  No link or component is collected; each round is written
to the shared folder, so a lost executor repeats one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return (both.join(least, "u").filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    return (e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v"))).distinct())


def components(links: DataFrame) -> DataFrame:
    """``links(u, v)`` -> ``(node, root)``: root is the smallest node that the
    node reaches.  Nodes without a link are absent; a root has no row itself."""
    e = (links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .filter("u <> v").distinct())
    e = stage(e, "links")
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = tuple(now)
        if not mark[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        e, old = stage(_small_star(_large_star(e)), "links"), e
        discard(old)
