"""Connected components over a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logharrow.llm.scratch import drop, materialise


def _large_star(links: DataFrame) -> DataFrame:
    """Each node links its larger neighbours to its smallest one (or itself)."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(links.select("b", "a"))
    least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return both.where("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Each node links its smaller neighbours and itself to the smallest of them."""
    least = materialise(links.groupBy("b").agg(F.min("a").alias("m")), "least")
    others = links.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return others.union(least.select(F.col("m").alias("a"), "b"))


def components(links: DataFrame) -> DataFrame:
    """Component of every node that has a link: node, root (the least node reachable).

    links: columns a and b, integers with a < b, repeats allowed; rows with a null or with a = b are ignored. Every
    round is written to the scratch folder; the driver sees only a count and a checksum. Both steps join each link to
    one row a node, written first, so a node with very many links is a skewed join that can be split, never one group
    in one task.
    """
    clean = links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    now, seen = materialise(clean, "links"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
        large = materialise(_large_star(now).where("a != b").distinct(), "links")
        after = materialise(_small_star(large).where("a != b").distinct(), "links")
        drop(now)
        drop(large)
        now, seen = after, mark
