"""Connected components of a table of links, by alternating star contractions.

Every pass hangs each node on the smallest node around it, first among its larger neighbours, then among its
smaller ones, until nothing changes. Passes use grouped minima and joins only: no node's neighbours are
collected, and a node with very many is a skewed join key, which adaptive execution splits. Each
pass is written to the shared folder, so no lineage grows and lost executors cost one pass at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.rows import dropped, stored


def _sum(links: DataFrame) -> tuple:
    a = F.xxhash64("u", "v")
    return links.agg(F.count("*"), F.sum(a.bitwiseAND(F.lit((1 << 40) - 1))), F.sum(F.shiftright(a, 40))).first()


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours hang on the smallest of it and its neighbours."""
    both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours hang on the smallest of them."""
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node that can be reached, for every node with a link; `links` has columns u and v."""
    now = stored(links.where(~F.col("u").eqNullSafe(F.col("v"))).select("u", "v").distinct(), "links")
    before, state = None, _sum(now)
    while state != before:
        following = stored(_small_star(_large_star(now)), "links")
        dropped(now)
        now, before, state = following, state, _sum(following)
    roots = now.select(F.col("v").alias("u"), "v").distinct()
    return now.unionAll(roots).select(F.col("u").alias("node"), F.col("v").alias("root"))
