"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandspark.llm.common import stage_tidily as stage


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def connected(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every linked node but the roots.

    ``links`` has columns a, b. Each round hangs every node under the smallest of
    its neighbours, first the larger neighbours, then the smaller ones; the rounds
    are logarithmic in the size of a component. A node with many links is a key
    with one row on the other side of each join, so it can be split.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, last = stage(pairs), None
    while (now := _state(pairs)) != last and now[0]:
        last = now
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.unionByName(pairs.join(least.hint("merge"), "u").select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u")
        under = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stage(under.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
