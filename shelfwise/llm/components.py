"""Connected components of a link table, by alternating large-star and small-star steps.

Every step is a group-by-minimum and a join; each round is written to the shared folder, and only two numbers of it
come to the driver. A star or clique ends in one or two rounds, a chain in about the logarithm of its length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.materialise import settle


def components(links: DataFrame) -> DataFrame:
    """``links`` has longs a and b. Gives v and label, the smallest vertex of its component; isolated ones are absent
    and a component's smallest vertex has itself."""
    edges = settle(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .filter("u <> v").distinct(), "links").frame

    def state(rows: DataFrame) -> tuple:
        mark = F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 31)))
        return tuple(rows.agg(F.count(F.lit(1)), mark).first())

    before = state(edges)
    while before[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = settle(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "links").frame
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("v"), F.col("v").alias("label")).distinct()
    return settle(edges.select(F.col("u").alias("v"), F.col("v").alias("label")).union(roots), "labels").frame
