"""Connected components of a table of links, by alternating star contraction.

Each round replaces the links around a vertex by links to its smallest
neighbour, first for larger neighbours, then for smaller ones; the number of
links never grows and the rounds needed grow with the logarithm of the
vertices. Every round is written to the shared folder, so lineage stays short
and a lost executor repeats one round at most. Minima are plain aggregates with
map-side combine and the joins are left to Spark, so hubs may be hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windlass.llm.common import write_table


def components(links: DataFrame) -> DataFrame:
    """``links`` (src, dst: long) -> (src, dst): each vertex that is not the
    smallest of its component, with the smallest. Loops and repeats are fine."""
    both_ways = links.filter("src <> dst").select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    now = write_table(both_ways.distinct(), "links")
    seen = _sum(now)
    while seen[0]:
        now = write_table(_round(now), "links", seen[0])  # links never grow in number
        after = _sum(now)
        if after == seen:
            break
        seen = after
    return now


def _sum(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _round(links: DataFrame) -> DataFrame:
    around = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    least = around.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))
    large = (around.filter("dst > src").join(least, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
             .distinct())
    low = large.groupBy("src").agg(F.min("dst").alias("low"))
    moved = large.join(low, "src").filter("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.unionByName(low.select("src", F.col("low").alias("dst"))).distinct()
