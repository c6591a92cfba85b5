"""Connected components of a link table, by alternating large and small stars.

Every round is two grouped minima and joins on the node, written before the
next, so a lost executor costs one round. Links, labels and components stay in
Spark; the driver sees two numbers a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenospark.sinks import materialise


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star step on distinct links a > b."""
    if large:  # each larger neighbour of u points to the least of u's neighbourhood
        both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # u and its smaller neighbours point to the least of them
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            least.select("a", F.col("m").alias("b")))
    return out.where("a != b").distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root: each node of ``links`` (two columns of one type) with the
    least node of its component; nodes without links don't appear."""
    a, b = links.columns
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b").distinct()
    now, mark = materialise(links, "links"), None
    while True:
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        now = materialise(_star(_star(now, True), False), "links")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
