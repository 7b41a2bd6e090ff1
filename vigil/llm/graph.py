"""Connected components by alternating large-star and small-star steps.

Each step is one aggregation with map-side combine and one join; the links of a hub lie in as many tasks as the join needs.
The number of links never grows. Every step's links are written to the shared folder, so the plan stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % (1 << 31))).first())


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the least node reachable) of every node but the roots, from links ``u``, ``v``.

    Links may repeat, point either way or lead to their own node; null ends are left out.
    """
    links = stored(links.filter("u <> v").select("u", "v").distinct())
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links).distinct()).distinct())
        before, state = state, _state(links)
        if state == before:
            break
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
